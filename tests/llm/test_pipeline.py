import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from docspark.llm import mixing, pii
from docspark.runtime import materialize
from tests.llm.test_jaccard import brute


def test_stages(spark, sf):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "jaccard_join", "personal_data", "mixing", "packing"]
    docs = first = spark.read.parquet(f"{sf}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = materialize(stage(spark, docs, sf), name)
        assert docs.columns == first.columns or name == "packing"
    ids = lambda name: {r["doc_id"] for r in out[name].select("doc_id").collect()}
    assert ids("jaccard_join") < ids("language_id") and ids("personal_data") == ids("jaccard_join")
    assert ids("mixing") <= ids("personal_data") and ids("packing") == ids("mixing")
    mixed = out["mixing"].collect()
    assert all(r["n_chars"] == len(r["text"]) for r in mixed)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    total = sum(len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in mixed)
    assert out["packing"].agg({"length": "sum"}).first()[0] == total


def test_batches_of_large_rows_are_bounded(spark):
    """Rows of a stage may hold far more than a text: what is sent at once is bounded in bytes too."""
    rows = spark.range(0, 1000, 1, 1).selectExpr("repeat('x', 20000) as text")
    corpus_pipeline.prepare(spark)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes])})

    found = [r["n"] for r in rows.mapInArrow(sizes, "n long").collect()]
    assert sum(found) > 20_000_000 and max(found) < 2 * corpus_pipeline.ARROW_BYTES


def test_empty_table(spark, hostile):
    docs = hostile.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_run_against_brute_force(spark, sf):
    """Each stage's rows by a plain loop over what the stage before kept, and run()'s rows by those of the last."""
    docs, stages = spark.read.parquet(f"{sf}/documents.parquet"), dict(corpus_pipeline.STAGES)
    docs = materialize(stages["language_id"](spark, docs, sf), "language")
    kept = materialize(stages["jaccard_join"](spark, docs, sf), "kept")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in brute(rows)})
    clean = materialize(stages["personal_data"](spark, kept, sf), "clean")
    finder = pii.fit(kept)
    before = {r["doc_id"]: r["text"] for r in kept.collect()}
    for r in clean.collect():
        base = pii.base_spans(before[r["doc_id"]])
        assert r["text"] == pii.redacted(before[r["doc_id"]], base + finder.extra(before[r["doc_id"]], base))
    mixed = materialize(stages["mixing"](spark, clean, sf), "mixed")
    n_words = lambda t: len([w for w in t.translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w])
    want = {r["doc_id"]: r["first"] + r["second"] for r in mixing.mix(clean).collect()}
    got = Counter()
    for r in mixed.collect():
        got[r["doc_id"]] += n_words(r["text"])
    assert got == Counter({k: n for k, n in want.items() if n})
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sizes = Counter()
    for r in mixed.collect():
        ids = tokenizer.encode(r["text"], add_special_tokens=False).ids + [1]
        sizes[r["doc_id"], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    pieces = [r.asDict() for r in corpus_pipeline.run(spark, sf).collect()]
    packed = Counter()
    for p in pieces:
        packed[p["doc_id"], p["doc_tokens"]] += p["length"]
    total = Counter()
    for (doc, n, _), k in sizes.items():
        total[doc, n] += n * k
    assert packed == total
    uncut = Counter((p["doc_id"], p["length"], p["ids_crc32"]) for p in pieces if p["length"] == p["doc_tokens"])
    assert uncut and all(sizes[key] >= k for key, k in uncut.items())
