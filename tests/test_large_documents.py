"""Documents by reference: entries of any size pass through readers, stores and sinks byte for byte."""

import gzip
import random
import zipfile

import pytest

from docspark.operators.redact import redact
from docspark.sinks.export import export_archive, export_files, export_zip
from docspark.sinks.store import compact_store, scan_docs, upsert_docs, write_store
from docspark.sources import zipped
from docspark.sources.archive import read_archive
from docspark.sources.zipped import read_gzip_docs, read_zip_docs

LIMIT = 5000


@pytest.fixture
def contents():
    rng = random.Random(1)
    return {"small.txt": b"small", "zeros.bin": b"\0" * 3_000_000, "noise.bin": rng.randbytes(200_000), "text.xml": b"<a>" + b"x" * 9000 + b"</a>", "edge.txt": b"e" * LIMIT}


@pytest.fixture
def archive(contents, tmp_path):
    path = tmp_path / "in" / "a.zip"
    path.parent.mkdir()
    with zipfile.ZipFile(path, "w") as z:
        for k, (name, data) in enumerate(contents.items()):
            z.writestr("/d/" + name, data, zipfile.ZIP_STORED if k % 2 else zipfile.ZIP_DEFLATED)
    return path


def files_below(folder):
    return {p.name: p.read_bytes() for p in folder.rglob("*") if p.is_file() and not p.name.startswith((".", "_"))}


def test_large_entries_are_rows_by_reference(spark, archive, contents):
    rows = {r["uri"].rpartition("/")[2]: r for r in read_zip_docs(spark, str(archive), max_bytes=LIMIT).collect()}
    assert {n for n, r in rows.items() if r["ref"]} == {"zeros.bin", "noise.bin", "text.xml"}
    assert all(r["skip_reason"] is None and (r["ref"] is None) == (r["text"] is not None or r["bytes"] is not None) for r in rows.values())
    assert read_zip_docs(spark, str(archive)).where("ref is not null or skip_reason is not null").count() == 0


def test_through_every_sink(spark, archive, contents, tmp_path):
    docs = read_zip_docs(spark, str(archive), max_bytes=LIMIT)
    assert export_files(docs, str(tmp_path / "files")).where("error is not null").count() == 0
    assert files_below(tmp_path / "files") == contents
    export_zip(docs, str(tmp_path / "zips"))
    export_archive(docs, str(tmp_path / "archives"))
    again = read_archive(spark, str(tmp_path / "archives"), max_bytes=LIMIT)
    assert again.where("ref is not null").count() == 3 and again.where("skip_reason is not null").count() == 0
    for k, back in enumerate([read_zip_docs(spark, str(tmp_path / "zips"), max_bytes=LIMIT), again, read_archive(spark, str(tmp_path / "archives"))]):
        export_files(back, str(tmp_path / f"back{k}"))
        assert files_below(tmp_path / f"back{k}") == contents


def test_a_store_keeps_large_documents_itself(spark, archive, contents, tmp_path):
    store = str(tmp_path / "store")
    write_store(read_zip_docs(spark, str(archive), max_bytes=LIMIT), store)
    archive.unlink()
    for k in range(2):
        export_files(scan_docs(spark, store), str(tmp_path / f"out{k}"))
        assert files_below(tmp_path / f"out{k}") == contents
        upsert_docs(scan_docs(spark, store).where("uri like '%noise.bin'"), store)
        compact_store(spark, store)


def test_large_gzip_files(spark, contents, tmp_path):
    top = tmp_path / "gz"
    top.mkdir()
    for name, data in contents.items():
        # several members, the way large files are often packed
        (top / f"{name}.gz").write_bytes(gzip.compress(data[:1000]) + gzip.compress(data[1000:]))
    docs = read_gzip_docs(spark, str(top), max_bytes=LIMIT)
    assert docs.where("ref = 'gzip'").count() == 3
    export_files(docs, str(tmp_path / "out"))
    assert files_below(tmp_path / "out") == contents


def test_unpacked_pieces_are_bounded(archive):
    with zipfile.ZipFile(archive) as z:
        info = z.getinfo("/d/zeros.bin")
    with open(archive, "rb") as f:
        sizes = [len(c) for c in zipped.entry_chunks(f, info.header_offset, info.compress_size, info.compress_type)]
    assert sum(sizes) == 3_000_000 and max(sizes) <= 1 << 20


def test_redaction_does_not_let_them_pass(spark, archive):
    docs = read_zip_docs(spark, str(archive), max_bytes=LIMIT).where("content_type = 'XML'")
    with pytest.raises(Exception, match="by reference"):
        redact(docs, [{"path": "/a", "kind": "mask"}]).collect()


def test_truncated_gzip_is_no_document(spark, tmp_path):
    data = gzip.compress(random.Random(1).randbytes(5000))
    files = {"cut.gz": data[:-100], "trailer.gz": data[:-4], "whole.gz": data, "two.gz": data + b"\0" * 9 + data, "padded.gz": data + b"\0" * 600, "second.gz": data + data[:50]}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    rows = {r.src_id.rpartition("/")[2]: r for r in read_gzip_docs(spark, str(tmp_path)).collect()}
    assert {n for n, r in rows.items() if r.skip_reason} == {"cut.gz", "trailer.gz", "second.gz"}
    assert all("ends inside a member" in r.skip_reason for r in rows.values() if r.skip_reason)
