"""Documents by reference: where their bytes lie, for those too large for a row.

A reference is a text in column ``ref`` and says how the bytes lie in the file ``src_id``: ``file`` (all of it), ``gzip`` (all of
it, packed), or ``zip:METHOD:OFFSET:PACKED`` (an entry, by the offset of its header and its packed size). Such a row has neither
text nor bytes; sinks stream it, a piece at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

from docspark.sources.io import open_input

WHOLE, GZIP = "file", "gzip"
_CHUNK = 1 << 20


def zip_ref(method: int, offset: int, csize: int) -> str:
    return f"zip:{method}:{offset}:{csize}"


def chunks(src_id: str, ref: str) -> Iterator[bytes]:
    """The bytes of a referenced document, in pieces of bounded size."""
    from docspark.sources.zipped import entry_chunks, gunzip_chunks

    with open_input(src_id) as f:
        if ref == WHOLE:
            yield from iter(lambda: f.read(_CHUNK), b"")
        elif ref == GZIP:
            yield from gunzip_chunks(f)
        elif ref.startswith("zip:"):
            method, offset, csize = map(int, ref.split(":")[1:])
            yield from entry_chunks(f, offset, csize, method)
        else:
            raise ValueError(f"unknown reference {ref}")
