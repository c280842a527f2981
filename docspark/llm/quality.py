"""Document statistics, and quality by boosted trees over them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.boosting import Forest, train
from docspark.llm.common import SPACE, buffers, groups, narrowed, windows, words

#: Words in a window that counts as repeated when the text has it twice.
WINDOW = 8
#: A text fails the base rule below this many words, or with a larger share (%) of repeated words.
LEAST_WORDS, MOST_REPEATED = 20, 30
#: Most labelled texts the trees are fitted on.
SAMPLE = 20_000
#: Share of the texts labelled good, beyond the base rule, that the verdict may cost at most.
COST = 0.002
#: Bytes of text measured at a time.
BLOCK = 8 << 20

# What counts as a symbol.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

_POINT = (np.arange(256) & 0xC0) != 0x80
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!\"'(),-./:;=?@[\\]^_`{}~+")] = True
_BLANK = " \t\n\x0b\x0c\r"

#: Model inputs, and how the verdict may depend on those that are named.
FEATURES = ["log_words", "word_length", "symbols", "dup_lines", "repeated", "upper", "digits", "marks", "distinct", "line_words"]
MONOTONE = {"symbols": -1, "dup_lines": -1, "repeated": -1, "upper": -1}


def repeated(doc: np.ndarray, hashes: np.ndarray, n_texts: int, size: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window which the text has twice or more."""
    at, h = windows(doc, hashes, size)
    owner = doc[at]
    order = np.lexsort((h, owner))
    same = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    depth = np.zeros(len(doc) + 1, np.int64)
    np.add.at(depth, at[twice], 1)
    np.add.at(depth, at[twice] + size, -1)
    covered = np.cumsum(depth[:-1]) > 0
    return np.bincount(doc[covered], minlength=n_texts)


def dup_lines(text: str) -> tuple[int, int]:
    """(lines that hold a word and equal an earlier one, lines that hold a word)."""
    seen: set[str] = set()
    dup = full = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
            full += 1
        elif line.strip(_BLANK):
            seen.add(line)
            full += 1
    return dup, full


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """Whole-text counts of a column of texts, as one array each."""
    data, offsets = buffers(texts)
    n = len(offsets) - 1
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "upper", "digits", "marks", "distinct", "lines"]
    out = {k: np.zeros(n, np.int64) for k in names}
    for lo, hi in groups(data, offsets, BLOCK):
        own = offsets[lo : hi + 1] - offsets[lo]
        part = data[offsets[lo] : offsets[hi]]

        def per_text(mask: np.ndarray, own=own) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
            return np.diff(total[own])

        doc, h = words(part, own)
        out["n_words"][lo:hi] = np.bincount(doc, minlength=hi - lo)
        out["n_repeat_words"][lo:hi] = repeated(doc, h, hi - lo)
        out["word_chars"][lo:hi] = per_text(_POINT[part] & ~SPACE[part])
        for name, table in (("n_symbols", SYMBOLS), ("upper", _UPPER), ("digits", _DIGIT), ("marks", _MARK)):
            out[name][lo:hi] = per_text(table[part])
        order = np.lexsort((h, doc))
        new = np.ones(len(doc), bool)
        new[1:] = (doc[order][1:] != doc[order][:-1]) | (h[order][1:] != h[order][:-1])
        out["distinct"][lo:hi] = np.bincount(doc[order][new], minlength=hi - lo)
        for i in range(lo, hi):
            out["n_dup_lines"][i], out["lines"][i] = dup_lines(texts[i].as_py() or "")
    return out


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    w, c, ln = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1), np.maximum(s["lines"], 1)
    cols = {
        "log_words": np.log1p(s["n_words"]),
        "word_length": s["word_chars"] / w,
        "symbols": s["n_symbols"] / w,
        "dup_lines": s["n_dup_lines"] / ln,
        "repeated": s["n_repeat_words"] / w,
        "upper": s["upper"] / c,
        "digits": s["digits"] / c,
        "marks": s["marks"] / c,
        "distinct": s["distinct"] / np.sqrt(w),
        "line_words": s["n_words"] / ln,
    }
    return np.column_stack([cols[k] for k in FEATURES])


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < LEAST_WORDS) | (100 * s["n_repeat_words"] > MOST_REPEATED * s["n_words"])


@dataclass
class Verdict:
    """Trees, and the score from which a text is kept."""

    forest: Forest
    least: float


def fit(df: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Verdict:
    """Fit trees on a bounded sample of the labelled texts (doc_id, text) x (doc_id, quality 0/1).

    At most ``sample`` ids are used, picked by a hash of the id, and one text of each; only their statistics go to the driver. A score
    that ``COST`` of the sample's good texts fall short of is the least that is kept, and 0.5 at most. Without labels,
    or with one kind only, all texts that pass the base rule are kept.
    """
    marked = narrowed(labels, doc_id="bigint", quality="int").filter("doc_id is not null and quality in (0, 1)")
    marked = marked.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    picked = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = narrowed(df, doc_id="bigint", text="string").join(F.broadcast(picked), "doc_id")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s = statistics(batch.column("text"))
                rows = features(s)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column("doc_id"), "x": [r.tobytes() for r in rows], "quality": batch.column("quality"), "failed": base_failed(s)}
                )

    measured = texts.select("doc_id", "text", "quality").mapInArrow(measure, "doc_id bigint, x binary, quality int, failed boolean")
    # one row per picked id, however many rows have it: the one with the least statistics, in whatever order they come
    got = measured.groupBy("doc_id").agg(F.min(F.struct("x", "quality", "failed")).alias("row")).select("row.*").toArrow()
    got = got.sort_by([("x", "ascending"), ("quality", "ascending")]) if got.num_rows else got
    rows = np.array([np.frombuffer(x.as_py()) for x in got.column("x")]).reshape(-1, len(FEATURES))
    label, failed = got.column("quality").to_numpy().astype(float), got.column("failed").to_numpy(zero_copy_only=False).astype(bool)
    forest = train(rows, label, {FEATURES.index(k): v for k, v in MONOTONE.items()})
    good = forest.probability(rows[(label == 1) & ~failed])
    spared = len(good) > 0 and len(np.unique(label)) == 2
    return Verdict(forest, min(0.5, float(np.quantile(good, COST, method="lower"))) if spared else -1.0)


def judge(df: DataFrame, verdict: Verdict) -> DataFrame:
    """Statistics, ``score`` and ``kept`` of each (doc_id, text).

    Null counts as a text without words, which fails the base rule. Every row gets a row, repeated ids and texts too,
    so that equal texts have equal results; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = statistics(batch.column("text"))
            failed, score = base_failed(s), verdict.forest.probability(features(s))
            cols = {k: pa.array(s[k]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), **cols, "base_failed": pa.array(failed), "score": pa.array(score), "kept": pa.array(~failed & (score >= verdict.least))}
            )

    kinds = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"
    return narrowed(df, doc_id="bigint", text="string").mapInArrow(run, kinds)
