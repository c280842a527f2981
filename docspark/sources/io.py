"""Opening files inside tasks, on any file system the cluster shares."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import unquote, urlsplit

from pyarrow import fs as pafs


def resolve(path: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path) for a path as Spark reports it."""
    if not re.match(r"^[A-Za-z][A-Za-z0-9+.\-]*:", path):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    # Hadoop's names for the same object store
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


def open_input(path: str):
    """Seekable binary file."""
    fs, p = resolve(path)
    return fs.open_input_file(p)


def open_stream(path: str):
    fs, p = resolve(path)
    return fs.open_input_stream(p, compression=None)


class Entry(NamedTuple):
    """What a listing says of a file or directory, with calls that give its time in nanoseconds and its bytes."""

    name: str
    path: str
    is_dir: bool
    changed: Callable[[], int]
    size: Callable[[], int]


def entries(fs, folder: str) -> Iterator[Entry]:
    """A directory's entries. Local ones are read piece by piece; other file systems give a directory's listing at once."""
    if isinstance(fs, pafs.LocalFileSystem):
        with os.scandir(folder) as found:
            for e in found:
                yield Entry(e.name, e.path, e.is_dir(), lambda e=e: e.stat().st_mtime_ns, lambda e=e: e.stat().st_size)
    else:
        for e in fs.get_file_info(pafs.FileSelector(folder)):
            yield Entry(e.base_name, e.path, e.type == pafs.FileType.Directory, lambda e=e: e.mtime_ns, lambda e=e: e.size)


class AtomicFile:
    """Write to a name of its own, then move into place: a repeated task replaces, never mixes."""

    def __init__(self, path: str, attempt: str):
        self.fs, self.path = resolve(path)
        head, _, tail = self.path.rpartition("/")
        self.tmp = f"{head}/_{attempt}.{tail}"
        self.fs.create_dir(head, recursive=True)
        self.stream = self.fs.open_output_stream(self.tmp, compression=None)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.tmp, self.path)

    def discard(self) -> None:
        """Leave nothing behind."""
        self.stream.close()
        self.fs.delete_file(self.tmp)


def path_of(uri: str) -> str:
    """Decoded path portion of a file URI."""
    return unquote(urlsplit(uri).path) if uri.startswith("file:") else uri
