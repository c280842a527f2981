"""The members of one huge JSON object, found by many tasks.

How it runs:

1. files are cut into blocks. A block may begin outside a string, inside one, or inside one behind a backslash. A task finds
   the quotes that no backslash takes and, outside strings, the brackets; for each of the three beginnings it returns how the block
   ends and by how much the depth of brackets changes;
2. the rows of a file, one per block, are chained, which tells every block's true beginning and depth;
3. each block gives the members behind the commas of depth one that it holds, its last member read on to its end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.runtime import materialize, ship
from docspark.sources.io import open_input
from docspark.sources.xml_blocks import block_size, spread

OUTSIDE, INSIDE, ESCAPED = range(3)
_QUOTE, _BACKSLASH, _COMMA, _OPEN, _CLOSE = b'"\\,{}'
_STEP = np.zeros(256, np.int8)
_STEP[[ord("{"), ord("[")]], _STEP[[ord("}"), ord("]")]] = 1, -1
_STRUCTURE = _STEP != 0
_STRUCTURE[_COMMA] = True
_MARK = b"\xef\xbb\xbf"
_READ = 1 << 20
#: Bytes of members that are parsed as one row, unless a single member has more.
ROW_BYTES = 1 << 20
_SCAN_DDL = "src_id string, start bigint, length bigint, ends array<int>, depths array<bigint>, blank boolean"
_PLACE_DDL = "src_id string, start bigint, length bigint, state int, depth bigint, begun boolean, closed boolean"


def _quotes(data: np.ndarray, escaped: bool) -> tuple[np.ndarray, bool]:
    """(places of the quotes that begin or end a string, whether the byte behind ``data`` is escaped); ``escaped`` says so of
    its first byte."""
    quotes = np.flatnonzero(data == _QUOTE)
    backslashes = np.zeros(len(quotes), np.int64)
    active = np.arange(len(quotes))
    while len(active):
        before = quotes[active] - backslashes[active] - 1
        active = active[(before >= 0) & (data[np.maximum(before, 0)] == _BACKSLASH)]
        backslashes[active] += 1
    # a run that begins the block loses its first backslash if that one is escaped, as does a quote there
    odd = (backslashes + (escaped & (backslashes == quotes))) % 2 == 1
    run, n = 0, len(data)
    while run < n and data[n - 1 - run] == _BACKSLASH:
        run += 1
    return quotes[~odd], bool((run + (escaped and run == n)) % 2)


def _structure(data: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """(places of brackets and commas outside strings, the state at the end)."""
    quotes, escaped = _quotes(data, state == ESCAPED)
    inside = state != OUTSIDE
    places = np.flatnonzero(_STRUCTURE[data])
    places = places[(np.searchsorted(quotes, places) + inside) % 2 == 0]
    if (len(quotes) + inside) % 2 == 0:
        return places, OUTSIDE
    return places, ESCAPED if escaped else INSIDE


def _read(f, start: int, n: int) -> bytes:
    f.seek(start)
    return f.read(n)


def _block(f, start: int, size: int) -> bytes:
    """A block, its byte order mark as spaces."""
    data = _read(f, start, size)
    return b"   " + data[3:] if start == 0 and data.startswith(_MARK) else data


def _scan(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                with open_input(row.src_id) as f:
                    block = _block(f, row.start, size)
                data = np.frombuffer(block, np.uint8)
                found = [_structure(data, state) for state in (OUTSIDE, INSIDE, ESCAPED)]
                depths = [int(_STEP[data[places]].sum(dtype=np.int64)) for places, _ in found]
                out = (row.src_id, row.start, row.length, [end for _, end in found], depths, not block.strip())
                yield pd.DataFrame([out], columns=["src_id", "start", "length", "ends", "depths", "blank"])

    return run


def _chain(blocks: pd.DataFrame) -> pd.DataFrame:
    """State and depth at the start of each block of a file, whether text lies before it, and whether all brackets of the
    file are closed."""
    blocks = blocks.sort_values("start")
    begun = (~blocks["blank"]).cumsum() - ~blocks["blank"] > 0
    state, depth, states, depths = OUTSIDE, 0, [], []
    for ends, steps in zip(blocks["ends"], blocks["depths"], strict=True):
        states.append(state)
        depths.append(depth)
        state, depth = int(ends[state]), depth + int(steps[state])
    return pd.DataFrame({"src_id": blocks["src_id"], "start": blocks["start"], "length": blocks["length"], "state": states, "depth": depths, "begun": begun, "closed": state == OUTSIDE and depth == 0})


def _rest(f, at: int, state: int, depth: int) -> Iterator[bytes]:
    """The bytes from ``at`` to the end of the member there."""
    while data := _read(f, at, _READ):
        array = np.frombuffer(data, np.uint8)
        places, state = _structure(array, state)
        steps = _STEP[array[places]]
        after = depth + np.cumsum(steps, dtype=np.int64)
        ends = places[((steps == 0) & (after == 1)) | (after < 1)]
        if len(ends):
            yield data[: ends[0]]
            return
        yield data
        at, depth = at + len(data), int(after[-1]) if len(after) else depth


def _members(f, row, size: int) -> Iterator[tuple[str | None, bool]]:
    """(an object of some members, False) for those whose comma or bracket lies in the block; (None, True) if there is text
    outside the top object."""
    data = _block(f, row.start, size)
    array = np.frombuffer(data, np.uint8)
    places, state = _structure(array, row.state)
    steps = _STEP[array[places]]
    after = row.depth + np.cumsum(steps, dtype=np.int64)
    opens = places[(steps == 1) & (after == 1)]
    closes = places[(steps == -1) & (after == 0)]
    fine = row.closed and (not len(after) or int(after.min()) >= 0) and len(closes) <= 1
    # nothing but the object stands in the file
    fine = fine and len(opens) == (row.depth == 0 and not row.begun and bool(data.strip()))
    fine = fine and not (row.depth == 0 and row.begun and data.strip())
    fine = fine and all(array[p] == _OPEN and not data[:p].strip() for p in opens)
    fine = fine and all(array[p] == _CLOSE and not data[p + 1 :].strip() for p in closes)
    if not fine:
        yield None, True
        return
    starts = places[((steps == 0) & (after == 1)) | ((steps == 1) & (after == 1))] + 1
    if not len(starts):
        return  # all inside a member that began before, or its end
    ends = np.append(starts[1:] - 1, closes[:1])

    def row_of(text: bytes, first: int) -> tuple[str, bool]:
        # only an object without members has nothing behind its bracket
        return "{" + text.decode("UTF-8", "replace") + "}", not text.strip() and not (first == 0 and len(opens) > 0)

    i, whole = 0, len(ends)
    while i < whole:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + ROW_BYTES, "right")))
        yield row_of(data[starts[i] : ends[j - 1]], i)
        i = j
    if whole < len(starts):
        rest = _rest(f, row.start + len(data), state, int(after[-1]))
        yield row_of(data[starts[-1] :] + b"".join(rest), whole)


def read_members(files: DataFrame, size: int | None = None) -> DataFrame:
    """(src_id, value, bad): the top objects of JSON files (src_id, bytes_n), as objects of some members each.

    ``bad`` marks a file whose text is not one object, by its brackets; the members themselves are not checked. ``size``: bytes
    of a block, of which a task holds one. Empty files give nothing.
    """
    spark = files.sparkSession
    ship(spark)
    size = max(len(_MARK), size or block_size(spark))
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes_n") - 1, F.lit(size).cast("bigint")))
    blocks = materialize(files.where("bytes_n > 0").select("src_id", F.col("bytes_n").alias("length"), starts.alias("start")), "json-blocks")
    n = blocks.count()
    scanned = spread(blocks, n, size).mapInPandas(_scan(size), _SCAN_DDL)
    placed = materialize(scanned.groupBy("src_id").applyInPandas(_chain, _PLACE_DDL), "json-places")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                with open_input(row.src_id) as f:
                    for value, bad in _members(f, row, size):
                        yield pd.DataFrame([(row.src_id, value, bad)], columns=["src_id", "value", "bad"])

    return spread(placed, n, size).mapInPandas(run, "src_id string, value string, bad boolean")
