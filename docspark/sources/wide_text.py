"""Lines of files whose characters take two or four bytes, read in blocks.

A block begins at a multiple of four bytes, so that its units are those of the file. A line belongs to the block that its first
unit lies in, and is read to its end.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.runtime import materialize, ship
from docspark.sources.io import open_input, resolve
from docspark.sources.xml_blocks import block_size, spread

#: Charset, without its byte order, to bytes of a unit.
UNITS = {"utf-16": 2, "utf-32": 4}
_LF, _CR = 10, 13
_READ = 1 << 20
_ROWS = 10_000
_BREAK = re.compile("\r\n?|\n")
_DDL = "value string, src_id string, block bigint"


def family(charset: str) -> str:
    """``utf-16`` or ``utf-32`` of a charset's own name, whatever its byte order; else the name."""
    return re.sub(r"-(le|be)$", "", charset)


def _order(charset: str, head: bytes) -> tuple[str, int]:
    """(charset with its byte order, bytes of the mark) by the first bytes of a file; big-endian without a mark."""
    base = family(charset)
    little, big = b"\xff\xfe" + b"\0" * (UNITS[base] - 2), b"\0" * (UNITS[base] - 2) + b"\xfe\xff"
    named = charset[len(base) + 1 :]
    if named != "be" and head.startswith(little):
        return base + "-le", len(little)
    if named != "le" and head.startswith(big):
        return base + "-be", len(big)
    return f"{base}-{named or 'be'}", 0


def _units(data: bytes, charset: str) -> np.ndarray:
    width = UNITS[family(charset)]
    whole = len(data) // width * width
    return np.frombuffer(data[:whole], f"{'<' if charset.endswith('le') else '>'}u{width}")


def _begins(units: np.ndarray, only_lf: bool) -> np.ndarray:
    """Places, from 1 on, of units that begin a line."""
    found = units[:-1] == _LF
    if not only_lf:
        found = found | ((units[:-1] == _CR) & (units[1:] != _LF))
    return np.flatnonzero(found) + 1


def _block_text(f, start: int, size: int, charset: str, only_lf: bool) -> str | None:
    """The lines that begin in a block, None if none does."""
    f.seek(0)
    charset, mark = _order(charset, f.read(4))
    width = UNITS[family(charset)]
    if start == 0:
        # the first line is the first block's, even if the mark fills that block
        f.seek(mark)
        data = f.read(max(size - mark, width))
    else:
        f.seek(start - width)
        data = f.read(size + width)
        begins = _begins(_units(data, charset), only_lf)
        if not len(begins):
            return None
        data = data[begins[0] * width :]
    if not data:
        return None
    # what follows belongs to the last line, up to the first place that begins another one
    parts, last = [data], data[-width:]
    while more := f.read(_READ):
        begins = _begins(_units(last + more, charset), only_lf)
        if len(begins):
            parts.append(more[: (begins[0] - 1) * width])
            break
        parts.append(more)
        last = more[-width:]
    return b"".join(parts).decode(charset, "replace")


def _lines(text: str, only_lf: bool) -> list[str]:
    lines = text.split("\n") if only_lf else _BREAK.split(text)
    return lines[:-1] if lines[-1] == "" else lines


def _packed_lines(path: str, charset: str, only_lf: bool) -> Iterator[list[str]]:
    """The lines of a compressed file, a piece at a time."""
    import codecs

    fs, p = resolve(path)
    with fs.open_input_stream(p, compression="gzip") as f:
        head = f.read(4)
        charset, mark = _order(charset, head)
        decoder = codecs.getincrementaldecoder(charset)("replace")
        open_line = decoder.decode(head[mark:])
        while data := f.read(_READ):
            open_line += decoder.decode(data)
            # a CR at the end may be half of a line break
            cut = max(open_line.rfind("\n"), -1 if only_lf else open_line.rfind("\r", 0, -1)) + 1
            yield _lines(open_line[:cut], only_lf) if cut else []
            open_line = open_line[cut:]
        open_line += decoder.decode(b"", True)
        yield _lines(open_line, only_lf) if open_line else []


def read_wide_lines(files: DataFrame, charset: str, only_lf: bool = False, size: int | None = None) -> DataFrame:
    """(value, src_id, block) of the lines of files (src_id, bytes_n) in UTF-16 or UTF-32.

    A line ends with LF, CR or both; with ``only_lf`` at LF alone. A byte order mark is taken off; without one, and without an
    order in the charset's name, units are big-endian. Bytes that are no character are replaced. ``.gz`` files are read by one
    task each. Lines of a block come in order, in one partition.
    """
    spark = files.sparkSession
    ship(spark)
    size = max(4, (size or block_size(spark)) // 4 * 4)
    packed = F.lower("src_id").endswith(".gz")
    starts = F.when(packed, F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(F.lit(0).cast("bigint"), F.col("bytes_n") - 1, F.lit(size).cast("bigint")))
    blocks = materialize(files.where("bytes_n > 0").select("src_id", F.explode(starts).alias("block"), packed.alias("packed")), "text-blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["packed"]:
                    pieces = _packed_lines(row["src_id"], charset, only_lf)
                else:
                    with open_input(row["src_id"]) as f:
                        text = _block_text(f, row["block"], size, charset, only_lf)
                    pieces = [] if text is None else [_lines(text, only_lf)]
                for lines in pieces:
                    for i in range(0, len(lines), _ROWS):
                        some = lines[i : i + _ROWS]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(some, pa.string()), pa.array([row["src_id"]] * len(some), pa.string()), pa.array([row["block"]] * len(some), pa.int64())],
                            names=["value", "src_id", "block"],
                        )

    return spread(blocks, blocks.count(), size).mapInArrow(run, _DDL)
