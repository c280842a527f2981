"""Text buffers, word hashes and column plumbing that the operators share."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# A word is a run of bytes other than these.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: The same as a pattern.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text handled at a time inside a task; a longer text is still cut only between words.
SEGMENT = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x += np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTES = mix(np.arange(256))
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(which: str, n: int) -> np.ndarray:
    """The first ``n`` powers of the base or of its inverse, modulo 2^64."""
    have = _powers[which]
    if len(have) < n:
        size = 1 << (n - 1).bit_length()
        steps = np.full(size, _BASE if which == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        have = _powers[which] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def _segments(space: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    lo, n = 0, len(space)
    while lo < n:
        hi = min(lo + size, n)
        if hi < n:
            gaps = np.flatnonzero(space[lo:hi])
            if len(gaps):
                hi = lo + int(gaps[-1]) + 1
            else:
                rest = space[hi:]
                hi += int(rest.argmax()) if rest.any() else len(rest)
        yield lo, hi
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit hash) of every word of the texts that lie in ``data`` at ``offsets``.

    ``lower`` folds A-Z. A word's hash is the sum of a random value per byte times a power of an odd base; it is
    taken from one running sum, so that no word is handled alone.
    """
    space, values = SPACE[data], (_LOWER if lower else _BYTES)
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for lo, hi in _segments(space, SEGMENT):
        ink = ~space[lo:hi]
        begin = ink.copy()
        begin[1:] &= ~ink[:-1] | first[lo + 1 : hi]
        end = ink.copy()
        end[:-1] &= ~ink[1:] | first[lo + 1 : hi]
        a, b = np.flatnonzero(begin), np.flatnonzero(end)
        if not len(a):
            continue
        total = np.cumsum(values[data[lo:hi]] * _power("up", hi - lo), dtype=np.uint64)
        h = total[b] - np.where(a > 0, total[a - 1], np.uint64(0))
        starts.append(a + lo)
        hashes.append(mix(h * _power("down", hi - lo)[a]))
    at = np.concatenate(starts)
    return np.searchsorted(offsets, at, side="right") - 1, np.concatenate(hashes)


def windows(doc: np.ndarray, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of its first word, hash) of each run of ``size`` words that lies inside one text."""
    n = len(doc) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.flatnonzero(doc[:n] == doc[size - 1 :])
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        total = mix(total + hashes[at + k])
    return at, total


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    flat = pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary())
    if len(flat) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    body = flat.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def groups(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about ``size`` bytes; a longer text is a range of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield lo, hi
        lo = hi


def narrowed(df: DataFrame, **kinds: str) -> DataFrame:
    """Only the named columns, cast; what else the table has, under whatever names, is left out."""
    return df.select(*[df[f"`{name}`"].cast(kind).alias(name) for name, kind in kinds.items()])



def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def release() -> None:
    """Give freed memory back to the system: a worker lives on between tasks, and its memory counts beside the JVM's."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def releasing(run):
    """``run`` over the batches of a task, and the memory it freed given back when it ends."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return wrapped
