"""Language identification by the nearest of several centroids per language."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docspark.llm.common import narrowed, releasing
from docspark.runtime import materialize

#: Hashed n-gram dimensions.
SIZE = 1 << 13
#: Longest character n-gram.
GRAMS = 3
#: Most labelled texts per language that the centroids are fitted on, and most of all languages together.
PER_LANGUAGE = 400
SAMPLE = 20_000
#: Centroids per language.
CENTROIDS = 4
#: Most code points turned into n-grams at a time.
PIECE = 1 << 19
UNKNOWN = "und"

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def counts(text: str | None) -> np.ndarray | None:
    """Hashed counts of the letter n-grams (with word ends) of a text, or None if it has no letter."""
    total = None
    for lo in range(0, len(text or ""), PIECE):
        points = np.frombuffer(text[lo : lo + PIECE].lower().encode("utf-32-le"), np.uint32)
        is_letter = _is_letter()[points]
        if not is_letter.any():
            continue
        # any run of other characters is one gap; a gap stands at both ends
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1]
        line = np.concatenate([[0], np.where(is_letter, points, 0)[keep], [0]]).astype(np.uint64)
        total = np.zeros(SIZE) if total is None else total
        code = line
        for n in range(1, GRAMS + 1):
            if n > 1:
                code = code[:-1] * np.uint64(0x10FFFF + 7) + line[n - 1 :]
            mixed = (code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            slot = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(51)
            total += np.bincount(slot[code > 0].astype(np.int64), minlength=SIZE)
    return total


def matrix(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(sublinear term frequencies by row, has a letter by row)."""
    out = np.zeros((len(texts), SIZE), np.float32)
    has = np.zeros(len(texts), bool)
    for i, text in enumerate(texts):
        c = counts(text)
        if c is not None:
            out[i], has[i] = np.log1p(c), True
    return out, has


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


def cluster(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means over unit rows; the first centre is the mean, each next the row farthest from all."""
    centres = unit(rows.mean(axis=0, keepdims=True))
    while len(centres) < min(k, len(rows)):
        far = (rows @ centres.T).max(axis=1).argmin()
        centres = np.vstack([centres, rows[far]])
    for _ in range(rounds):
        own = (rows @ centres.T).argmax(axis=1)
        centres = unit(np.vstack([rows[own == c].mean(axis=0) if (own == c).any() else centres[c] for c in range(len(centres))]))
    return centres.astype(np.float32)


def bucket(mass: np.ndarray) -> np.ndarray:
    """Length class of a text by the norm-free size of its vector: texts of one word are far from any centroid."""
    return np.minimum(np.log2(np.maximum(mass, 1)).astype(int), 15)


@dataclass
class Centroids:
    """idf by slot, unit centroids, the language of each, and the least cosine accepted by length class."""

    idf: np.ndarray
    centres: np.ndarray
    langs: list[str]
    least: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, cosine in 0..1, rejected) of each text."""
        names, scores, far = [], [], []
        for lo in range(0, len(texts), 64):
            raw, has = matrix(texts[lo : lo + 64])
            if not len(self.langs):
                has[:] = False
                cosine = np.zeros((len(raw), 1), np.float32)
            else:
                cosine = unit(raw * self.idf) @ self.centres.T
            best = cosine.argmax(axis=1)
            score = np.clip(cosine[np.arange(len(best)), best].astype(float), 0.0, 1.0)
            names += [self.langs[b] if h else UNKNOWN for b, h in zip(best, has, strict=True)]
            scores.append(np.where(has, score, 0.0))
            far.append(~has | (score < self.least[bucket((raw > 0).sum(axis=1))]))
        join = lambda parts, kind: np.concatenate(parts) if parts else np.empty(0, kind)
        return names, join(scores, float), join(far, bool)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        for lo in range(0, len(texts), 64):
            rows, has = matrix(texts[lo : lo + 64])
            # the text's first words alone, too: what a short text of the language looks like
            short, some = matrix([" ".join((t or "")[:400].split()[:n]) for t, n in zip(texts[lo : lo + 64], _lengths(lo), strict=False)])
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": langs[lo : lo + 64] * 2,
                    "whole": [True] * len(rows) + [False] * len(short),
                    "vec": [r.astype(np.float16).tobytes() if h else None for r, h in zip([*rows, *short], [*has, *some], strict=True)],
                }
            )


def _lengths(lo: int) -> list[int]:
    return [1 + (lo + i) % 9 * ((lo + i) % 9) // 2 for i in range(64)]


def _rows(vectors: list[bytes]) -> np.ndarray:
    return np.vstack([np.frombuffer(v, np.float16) for v in vectors]).astype(np.float32)


def fit(df: DataFrame, per_language: int = PER_LANGUAGE, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Centroids:
    """Fit centroids on a bounded sample of the rows of ``df`` (doc_id, text, lang) whose lang is not null.

    At most ``per_language`` texts of a language are used, and ``sample`` in all; which ones is decided by a hash of
    the row. Vectors of the sample are made in tasks, and each language is clustered in a task of its own. Document
    frequencies of the n-grams come from the same sample. An empty table gives a model without languages.
    """
    rows = narrowed(df, doc_id="bigint", text="string", lang="string").filter("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Centroids(np.zeros(SIZE, np.float32), np.zeros((0, SIZE), np.float32), [], np.zeros(16))
    take = max(1, min(per_language, sample // len(sizes)))
    share = {k: min(1.0, 2.0 * take / n) if n > 2 * take else 1.0 for k, n in sizes.items()}
    pick = F.pmod(F.xxhash64("doc_id", F.lit(10)), F.lit(1 << 20)) / float(1 << 20)
    by_share = F.create_map(*[F.lit(x) for kv in share.items() for x in kv])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id"))
    chosen = rows.filter(pick < by_share[F.col("lang")]).withColumn("_rank", rank).filter(F.col("_rank") <= take)
    made = materialize(chosen.select("lang", "text").mapInArrow(releasing(_vectors), "lang string, whole boolean, vec binary"), "language").filter("vec is not null")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df_ = 0, np.zeros(SIZE)
        for b in batches:
            if b.num_rows:
                n, df_ = n + b.num_rows, df_ + (_rows(b.column("vec").to_pylist()) > 0).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"n": [n], "df": [df_.tobytes()]})

    parts = made.filter("whole").select("vec").coalesce(8).mapInArrow(frequencies, "n long, df binary").collect()
    n, df_ = sum(r["n"] for r in parts), sum(np.frombuffer(r["df"]) for r in parts)
    idf = (np.log((1 + n) / (1 + df_)) + 1).astype(np.float32)

    def centres(key: tuple, table: pa.Table) -> pa.Table:
        # rows come in any order; the clusters must not depend on it
        vectors = sorted(v.as_py() for v, w in zip(table.column("vec"), table.column("whole"), strict=True) if w.as_py())
        got = cluster(unit(_rows(vectors) * idf), centroids) if vectors else np.zeros((0, SIZE), np.float32)
        return pa.table({"lang": pa.array([key[0].as_py()] * len(got), pa.string()), "vec": pa.array([c.tobytes() for c in got], pa.binary())})

    got = made.groupBy("lang").applyInArrow(centres, "lang string, vec binary").collect()
    got.sort(key=lambda r: (r["lang"], bytes(r["vec"])))
    model = np.vstack([np.frombuffer(r["vec"], np.float32) for r in got]) if got else np.zeros((0, SIZE), np.float32)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.full(16, np.inf)
        for b in batches:
            if b.num_rows:
                raw = _rows(b.column("vec").to_pylist())
                np.minimum.at(least, bucket((raw > 0).sum(axis=1)), (unit(raw * idf) @ model.T).max(axis=1))
        yield pa.RecordBatch.from_pydict({"least": [least.tobytes()]})

    seen = made.select("vec").coalesce(8).mapInArrow(nearest, "least binary").collect() if len(model) else []
    least = np.min([np.frombuffer(r["least"]) for r in seen], axis=0) if seen else np.zeros(16)
    return Centroids(idf, model, [r["lang"] for r in got], limits(least))


def limits(least: np.ndarray) -> np.ndarray:
    """Least cosine accepted by length class: half of the least seen there, never less than a shorter class has."""
    return np.maximum.accumulate(np.where(np.isfinite(least), 0.5 * least, 0.0))


def identify(df: DataFrame, model: Centroids) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``rejected`` to (doc_id, text); text alone decides.

    A text that is null or has no letter gets ``und``, score 0 and is rejected, as is any text when the model has no
    language. Any other text gets the language of its nearest centroid; it is rejected if its cosine is below what the
    sample showed for texts of its length. Rows that repeat give rows that repeat; a null id stays null.
    """
    rows = narrowed(df, doc_id="bigint", text="string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, far = model.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(far, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    return rows.mapInArrow(releasing(run), "doc_id long, lang_pred string, score double, rejected boolean")


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept out of training: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def keep_identified(df: DataFrame) -> DataFrame:
    """The rows of ``df`` whose text is not rejected, all columns as they are."""
    model = fit(df.filter(~held_out()))
    fields = df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, _, far = model.predict(batch.column("text").to_pylist())
            yield batch.filter(pa.array(~far, pa.bool_()))

    return df.mapInArrow(releasing(run), fields)


def crc_fold(doc_id: int) -> bool:
    """``held_out`` of one id, for tests."""
    return zlib.crc32(str(doc_id).encode()) % 5 == 0

