import random
import zlib
from functools import cache
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from docspark.llm import encode, idfiles, packing

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LETTERS = [*"abAB  \n\n\t.,,!'sté́ßİΣς019一  \x1c\x00@-_×÷àÀ|$#`^~\\\"(", "'s", "'ll", " the", "<|endoftext|>", "\U0001f600"]


@cache
def tokenizer(path):
    one = Tokenizer.from_file(path)
    one.encode_special_tokens = True
    return one


def whole(path, text):
    return tokenizer(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_give_the_ids_of_whole_texts(path, words, monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(1500)] + [words(k, 300) for k in range(5)]
    one = encode.Encoder(path)
    assert one.kind
    assert [one.encode(t).tolist() for t in texts] == [whole(path, t) for t in texts]
    assert [a.tolist() for a in one.encode_all(pa.array(texts))] == [whole(path, t) for t in texts]
    monkeypatch.setattr(encode, "SLICE", 30)
    assert [one.encode(t).tolist() for t in texts[-5:]] == [whole(path, t) for t in texts[-5:]]


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    for high in (1, 2, 300, 50_000, 2**32 - 1):
        ids = rng.integers(0, high, 128 * 40, dtype=np.uint32)
        ids[:: 1 + high % 50] = rng.integers(0, 2**32 - 1, len(ids[:: 1 + high % 50]), dtype=np.uint32)
        body, index = idfiles.encode_blocks(ids)
        assert (idfiles.decode_blocks(np.frombuffer(body, np.uint8), index, 0) == ids).all()
    small = rng.integers(0, 256, 12_800, dtype=np.uint32)
    small[::100] = 2**31
    assert len(idfiles.encode_blocks(small)[0]) < 1.15 * 12_800  # a few outliers do not widen a block


def test_file_of_ids(tmp_path, monkeypatch):
    monkeypatch.setattr(idfiles, "FRAME", 2)
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 60_000, n, dtype=np.uint32) for n in (1, 0, 700, 128, 5, 3000)]
    writer = idfiles.Writer(str(tmp_path / "x.ids"), "a")
    for k, d in enumerate(docs):
        writer.add(None if k == 1 else k, d)
    writer.close()
    reader = idfiles.Reader(str(tmp_path / "x.ids"))
    assert reader.doc_ids == [0, None, 2, 3, 4, 5]
    assert [reader.document(k).tolist() for k in range(6)] == [d.tolist() for d in docs]
    assert np.concatenate(list(reader.frames())).tolist() == np.concatenate(docs).tolist()


@pytest.mark.parametrize("parts", [0, 5])
def test_ids_of_a_table(hostile, table, words, parts):
    df = table([(k, words(k, 30)) for k in range(100, 200)])
    df = df.repartition(parts) if parts else df
    rows, at = {}, 0
    for r in sorted(df.collect()):
        ids = whole(BYTE, r["text"] or "") + [2]
        rows[r["doc_id"]] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in idfiles.round_trip(df, BYTE).collect()} == rows
    if not parts:
        got = idfiles.round_trip(hostile, BYTE).collect()
        assert len(got) == hostile.count() and min(r["start"] for r in got if r["doc_id"] is None) == 0
        assert idfiles.round_trip(hostile.limit(0), BYTE).count() == 0


def test_ids_of_tables_in_any_shape(spark, words):
    """Sorted, joined and range-dealt tables, whose texts are too wide for one partition."""
    rows = [(k if k % 50 else None, words(k, 40) * 3) for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "10k")
    try:
        got = {name: sorted(map(tuple, idfiles.round_trip(shape, BYTE).collect()), key=str) for name, shape in {
            "sorted": df.orderBy("doc_id"),
            "ranges": df.repartitionByRange(7, "doc_id"),
            "joined": df.join(spark.range(3000).withColumnRenamed("id", "doc_id"), "doc_id", "left"),
            "one": df.coalesce(1),
        }.items()}
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    starts = sorted((r[1], r[2]) for r in got["sorted"])
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    with_id = {name: [r for r in found if r[0] is not None] for name, found in got.items()}
    assert all(found == with_id["one"] for found in with_id.values())


def check_packing(rows, texts, window):
    """Every id in one piece; sequences gapless and of full length or a power of two."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids, at = np.array(whole(WORD, texts[doc] or "") + [1], "<u4"), 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == window or at < window and at & (at - 1) == 0


def test_packing(table, words, monkeypatch):
    texts = {k: words(k, 1 + (k * 29) % 400) for k in range(150)} | {500: "", 501: None}
    rows = packing.pack(table(list(texts.items())), WORD, window=256).collect()
    check_packing(rows, texts, 256)


def test_packing_hostile(hostile):
    df = hostile.dropDuplicates(["doc_id"])
    check_packing(packing.pack(df, WORD).collect(), {r["doc_id"]: r["text"] for r in df.collect()}, packing.WINDOW)
    assert packing.pack(hostile.limit(0), WORD).count() == 0
    total = sum(r["length"] for r in packing.pack(hostile, WORD).collect())
    assert total == sum(len(whole(WORD, r["text"] or "")) + 1 for r in hostile.collect())
    with pytest.raises(ValueError):
        packing.pack(hostile, WORD, window=100)


def test_neighbours_are_the_best_by_bm25():
    rng = np.random.default_rng(0)
    docs = [rng.integers(10 * (k % 4), 10 * (k % 4) + 12, 40).astype(np.uint32) for k in range(24)]
    index = packing.Index(docs)
    size, n = np.array([len(d) for d in docs]), len(docs)

    def weight(t, d):
        tf = (docs[d] == t).sum()
        df = sum((x == t).any() for x in docs)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        return idf * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * size[d] / size.mean()))

    for seed in range(4):
        terms = sorted(set(docs[seed].tolist()), key=lambda t: (-np.float32(weight(t, seed)), t))[: packing.TERMS]
        want = {d: sum(weight(t, d) for t in terms) for d in range(n)}
        got = index.neighbours(seed, np.arange(n) != seed)
        assert np.allclose([want[d] for d in got], sorted((v for d, v in want.items() if d != seed and v > 0), reverse=True)[:64], rtol=1e-3)
        assert got[0] % 4 == seed


def test_windows_are_filled_with_related_texts():
    rng = np.random.default_rng(1)
    docs = [rng.integers(1000 * (k % 8), 1000 * (k % 8) + 30, 100).astype(np.uint32) for k in range(64)]
    rows, made = packing.pack_shard(docs, 512)
    topics = {}
    for d, _, _, _, _, number, _ in rows:
        topics.setdefault(number, set()).add(d % 8)
    assert made == 13 and sum(map(len, topics.values())) / made < 2.7


def related(topics, each, size=80):
    """Texts of topics in turn, so that those of one topic are never side by side: words of the topic and common ones."""
    rng = np.random.default_rng(2)
    docs = []
    for k in range(topics * each):
        own, common = rng.integers(0, 25, size // 2) + 1000 + 25 * (k % topics), rng.integers(0, 300, size // 2)
        docs.append(np.concatenate([own, common]).astype(np.uint32))
    return docs


def test_first_neighbours_from_afar_meet_in_a_shard(monkeypatch):
    monkeypatch.setattr(packing, "SHARD_DOCS", 64)
    docs = related(100, 20)
    stats = packing.Stats.of(docs)
    vectors = packing.Vectors(stats)
    fitted = packing.clusters(vectors.of(len(docs), *vectors.weighted(docs)))
    index, places = packing.Index(docs, stats), packing.Places(stats, fitted).of(docs).tolist()
    shard_of, shard, held, last = {}, 0, 0, None
    for d in sorted(range(len(docs)), key=lambda d: (*places[d], d)):
        if packing.shard_ends(0, held, places[d][0] != last):
            shard, held = shard + 1, 0
        shard_of[d], held, last = shard, held + 1, places[d][0]
    others = np.ones(len(docs), bool)
    recall = {"first": 0, "input order": 0, "any of ten": 0}
    for seed in range(0, len(docs), 5):
        others[seed] = False
        best = index.neighbours(seed, others)[:10].tolist()
        others[seed] = True
        recall["first"] += shard_of[best[0]] == shard_of[seed]
        recall["input order"] += best[0] // 64 == seed // 64
        recall["any of ten"] += any(shard_of[d] == shard_of[seed] for d in best)
    share = {k: v / (len(docs) / 5) for k, v in recall.items()}
    print(share)
    assert shard > 20 and share["input order"] < 0.1 and share["first"] >= 0.9 and share["any of ten"] > 0.95


def test_place_does_not_depend_on_the_batch():
    docs = [*related(10, 10), np.array([], np.uint32), np.array([7], np.uint32)]
    stats = packing.Stats.of(docs)
    vectors = packing.Vectors(stats)
    fitted = packing.clusters(vectors.of(len(docs), *vectors.weighted(docs)))
    places = packing.Places(stats, fitted)
    assert len(fitted) > 1 and (places.of(docs) == np.concatenate([places.of([d]) for d in docs])).all()
    assert places.of(docs)[-2].tolist() == [-1] * (1 + packing.KEYS) and places.of([]).shape == (0, 1 + packing.KEYS)


def test_texts_encoded_together_and_alone(words, monkeypatch):
    monkeypatch.setattr(encode, "TOGETHER", 300)
    monkeypatch.setattr(encode, "SLICE", 900)
    texts = [None, "", words(1, 40), "A  b\n\nC. d", words(2, 400), "Éa ÀB İi ΑΣ, 你好 x\ty", " ", words(3, 7), "don't THE the."]
    one = encode.Encoder(WORD)
    got = [a.tolist() for a in one.encode_all(pa.array(texts))]
    assert got == [whole(WORD, t or "") for t in texts]
    assert [a.tolist() for a in one.encode_all(pa.array(texts, pa.large_string()).slice(2, 5))] == got[2:7]
    assert list(one.encode_all(pa.array([], pa.string()))) == []


def test_weights_are_those_of_the_table():
    docs = related(20, 10)
    stats = packing.Stats.of(docs)
    part = packing.Index(docs[:50], stats)
    whole_, mine = packing.Index(docs, stats).scores(3)[:50], part.scores(3)
    assert np.allclose(whole_, mine)
    assert not np.allclose(packing.Index(docs[:50]).scores(3), mine)


def test_neighbours_beyond_a_page_are_in_order():
    docs = related(2, 150)
    index = packing.Index(docs)
    got, score = index.neighbours(0, np.arange(300) != 0), index.scores(0)
    assert len(got) == 299 and got.tolist() == sorted(range(1, 300), key=lambda d: (-score[d], d))


def test_related_texts_of_different_partitions_are_packed_together(table, words):
    texts = {k: words(k % 8, 12, 6) + " " + words(1000 + k, 3) for k in range(64)}
    df = table(sorted(texts.items()), schema="doc_id long, text string").repartitionByRange(8, "doc_id")
    rows = packing.pack(df, WORD, window=256).collect()
    check_packing(rows, texts, 256)
    topics = {}
    for r in rows:
        topics.setdefault(r["sequence_id"], set()).add(r["doc_id"] % 8)
    assert sum(map(len, topics.values())) / len(topics) < 3.5


def test_equal_chunks_of_neighbouring_texts_are_looked_up_once():
    """Ids are those of the library, also of texts with uneven white space between others."""
    made, asked = encode.Encoder(BYTE), []

    class Asked(dict):
        def __getitem__(self, part):
            asked.append(part)
            return chunks[part]

    chunks, made.chunks = made.chunks, Asked()
    texts = ["one two\nthree's one", "", " one  two", "two one", None, "one\ttwo", "twö 5x -- 'two' one\n", "one two"] * 20
    library = Tokenizer.from_file(BYTE)
    library.encode_special_tokens = True
    for text, ids in zip(texts, made.encode_all(pa.array(texts)), strict=True):
        assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids
    assert len(asked) == len(set(asked)) > 0


def test_small_caches_keep_the_encoding_worker_small(words, monkeypatch):
    """Fewer entries: fewer texts are looked up together, and each batch gives back what it freed; the ids are the same."""
    texts = [words(k, 100) for k in range(40)]
    one, small = encode.Encoder(WORD), encode.Encoder(WORD, 60_000, encode.CHUNKS // 8)
    assert (one.together, small.together) == (encode.TOGETHER, encode.TOGETHER // 8)
    small.together = 300
    assert [x.tolist() for x in small.encode_all(pa.array(texts))] == [x.tolist() for x in one.encode_all(pa.array(texts))]
    freed = []
    monkeypatch.setattr(packing, "release", lambda: freed.append(1))
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(40)), "text": pa.array(texts)})
    assert len(list(packing._encoded(WORD, 1, (60_000, 50_000))([batch, batch]))) == 3 and len(freed) == 2
