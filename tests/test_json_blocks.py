"""One huge JSON object in blocks, against the parser of the whole text."""

import json
import random

import pytest
from pyspark.sql import functions as F

from docspark.sources.files import list_files
from docspark.sources.json_blocks import read_members
from docspark.sources.rdf import read_rdf_json

STRINGS = ['a"b', "\\", '\\"', "{", "}", "[],", "é😀", "\\\\", "", "x" * 40, '",{"']


def _tree(seed, n):
    rng = random.Random(seed)

    def value(depth):
        kind = rng.randrange(4 if depth else 2)
        if kind < 2:
            return rng.choice(STRINGS)
        if kind == 2:
            return [value(depth - 1) for _ in range(rng.randrange(3))]
        return {rng.choice(STRINGS): value(depth - 1) for _ in range(rng.randrange(3))}

    return {f"{rng.choice(STRINGS)}{i}": value(3) for i in range(n)}


def _members(spark, path, size):
    rows = read_members(list_files(spark, str(path)), size).collect()
    out, bad = {}, set()
    for r in rows:
        name = r.src_id.rpartition("/")[2]
        if r.bad:
            bad.add(name)
        else:
            part = json.loads(r.value)
            assert not part.keys() & out.setdefault(name, {}).keys()
            out[name].update(part)
    return out, bad


@pytest.mark.parametrize("size", [3, 64, 1 << 20])
def test_members_against_the_parser(spark, tmp_path, size):
    want = {}
    for k in range(4):
        tree = _tree(k, 6 if size < 7 else 60)
        text = json.dumps(tree, ensure_ascii=bool(k % 2), indent=k or None)
        (tmp_path / f"{k}.json").write_bytes((b"\xef\xbb\xbf" if k == 3 else b"") + (f" \n{text}\n " if k else text).encode())
        want[f"{k}.json"] = tree
    (tmp_path / "none.json").write_text("{ \n }")
    (tmp_path / "empty.json").write_text("")
    got, bad = _members(spark, tmp_path, size)
    got.pop("none.json", None)
    assert got == want and not bad


@pytest.mark.parametrize("size", [3, 1 << 20])
def test_files_that_are_no_object(spark, tmp_path, size):
    texts = ['{"a": {}', '{"a": "x}', '{"a": 1} {"b": 2}', 'x {"a": 1}', '{"a": 1}}', '["a"]', '{"a": 1} x', "x", '{"a": 1},', '"a"', '{"a": {}, }']
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.json").write_text(text)
    rows = read_members(list_files(spark, str(tmp_path)), size)
    bad = rows.where(F.col("bad") | F.get_json_object("value", "$").isNull()).select("src_id").distinct().collect()
    assert {r.src_id.rpartition("/")[2] for r in bad} == {f"{i}.json" for i in range(len(texts))}


def _triples(df):
    return sorted(tuple(r) for r in df.select("s", "p", "o", "o_type", "datatype", "lang", "src_id", "skip_reason").collect())


def _key(rows):
    return sorted(map(repr, rows))


def test_rdf_json_in_blocks(spark, tmp_path):
    tree = {
        f"urn:s{i}" if i % 5 else f"_:b{i}": {
            "urn:p": [{"value": f'{{"{i}\\', "type": "literal", "lang": "en"}, {"value": "_:b0", "type": "bnode"}],
            "urn:q": [{"value": f"urn:o{i}", "type": "uri"}, {"value": "1", "type": "literal", "datatype": "urn:int"}],
        }
        for i in range(400)
    }
    (tmp_path / "big.rj").write_text(json.dumps(tree))
    (tmp_path / "small.rj").write_text('{"urn:x": {"urn:p": [{"value": "v", "type": "literal"}]}}')
    (tmp_path / "broken.rj").write_text(json.dumps(tree)[:-1])
    (tmp_path / "inner.rj").write_text(json.dumps(tree).replace('"urn:s77": {', '"urn:s77": {,'))
    columns = ("s", "p", "o", "o_type", "datatype", "lang", "src_id", "skip_reason")
    whole = read_rdf_json(spark, str(tmp_path), block=1 << 30).select(*columns)
    cut = read_rdf_json(spark, str(tmp_path), block=5000).select(*columns)
    assert _key(cut.collect()) == _key(whole.collect()) and whole.count() == 4 * 400 + 1 + 2
    tasks = read_members(list_files(spark, str(tmp_path), r"big\.rj"), 5000).select(F.spark_partition_id()).distinct().count()
    assert tasks > 1
