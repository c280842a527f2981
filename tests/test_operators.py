"""Operators against brute force on small or skewed data."""

import heapq
import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docspark.functions.text import words
from docspark.operators import aggregates, cooccurrence, filters, graphs, lexicon, mutate, placement, redact, transform
from docspark.operators.report import load_report, observe_load
from docspark.runtime import maybe_broadcast, with_positions
from docspark.schema import to_docs


def make_docs(spark, rows, **columns):
    df = spark.createDataFrame(rows, "uri string, text string")
    return to_docs(df, **columns)


def skewed(n=4000, seed=7):
    """A third of all rows in one group."""
    rng = random.Random(seed)
    return [("hot" if rng.random() < 0.34 else f"g{rng.randrange(40)}", rng.randrange(10**9), i) for i in range(n)]


def test_positions_of_a_hot_group(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, "g string, v long, id long").repartition(7)
    got = {r.id: r.pos for r in with_positions(df, ["v", "id"], ["g"]).collect()}
    want, groups = {}, defaultdict(list)
    for g, v, i in rows:
        groups[g].append((v, i))
    for members in groups.values():
        want |= {i: p for p, (_, i) in enumerate(sorted(members), 1)}
    assert got == want


def test_a_hot_group_is_ranked_by_many_tasks(spark):
    df = spark.createDataFrame(skewed(), "g string, v long, id long").repartition(7)
    sorted_parts = df.sort("g", "v", "id").where("g = 'hot'").select(F.spark_partition_id().alias("p"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert sorted_parts.distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_positions_null_groups_and_no_group(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2)], "g string, v long")
    assert sorted((r.g or "", r.v, r.pos) for r in with_positions(df, ["v"], ["g"]).collect()) == [("", 1, 1), ("", 3, 2), ("a", 2, 1)]
    assert [r.pos for r in with_positions(df, ["v"]).orderBy("v").collect()] == [1, 2, 3]


def test_weighted_positions(spark):
    rows = [(g, v, v % 5 + 1) for g, v, _ in {(g, v % 997, 0) for g, v, _ in skewed()}]
    df = spark.createDataFrame(rows, "g string, v long, w long").repartition(5)
    got = {(r.g, r.v): r.pos for r in with_positions(df, ["v"], ["g"], weight="w").collect()}
    at, want = Counter(), {}
    for g, v, w in sorted(rows):
        want[g, v] = at[g] + 1
        at[g] += w
    assert got == want


def test_join_sorted_cuts_a_frequent_value(spark):
    values = ["the"] * 700 + ["a"] * 5 + ["zoo"] * 3
    df = spark.createDataFrame([("g", v) for v in values], "g string, w string")
    parts = aggregates.join_sorted(df, ["g"], "w", chunk=100).orderBy("part").collect()
    assert " ".join(p.words for p in parts).split(" ") == sorted(values)
    assert [p.n for p in parts] == [100] * 7 + [8]


def test_pack_hot_graph(spark):
    rows = skewed()
    df = spark.createDataFrame(rows, "g string, v long, id long").repartition(6)
    packed = graphs.pack(df, F.col("id"), ["v", "id"], ["g"], 100).collect()
    sizes = Counter(g for g, _, _ in rows)
    assert all(len(p["items"]) == p.n <= 100 for p in packed)
    assert Counter(p.g for p in packed) == {g: -(-n // 100) for g, n in sizes.items()}
    got = [i for p in sorted(packed, key=lambda p: p.part) if p.g == "hot" for i in p["items"]]
    assert got == [i for _, i in sorted((v, i) for g, v, i in rows if g == "hot")]


def test_pack_triples_keeps_graph_as_collection(spark):
    df = spark.createDataFrame(
        [("s", "p", str(i), "literal", None, None, "urn:g", "f", "", i) for i in range(250)],
        "s string, p string, o string, o_type string, datatype string, lang string, graph string, src_id string, sub_id string, line long",
    )
    docs = graphs.pack_triples(df, collections=["extra"]).collect()
    assert sorted(d.text.count("<sem:triple>") for d in docs) == [50, 100, 100]
    assert all(d.collections == ["urn:g", "extra"] for d in docs) and len({d.uri for d in docs}) == 3


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 2000), min_size=1, max_size=6), st.integers(1, 300))
def test_balanced_target_equals_replay(spark, loads, batch):
    heap = [(c, t) for t, c in enumerate(loads)]
    heapq.heapify(heap)
    want = []
    for _ in range(60):
        c, t = heapq.heappop(heap)
        want.append(t)
        heapq.heappush(heap, (c + batch, t))
    got = spark.range(60).select(placement.balanced_target(F.col("id"), loads, batch).alias("t"), "id").orderBy("id").collect()
    assert [r.t for r in got] == want


DOCS = [("/a", "The cat, the dog."), ("/b", "Cat 42 über"), ("/c", "dog dog DOG"), ("/d", "")]


def test_word_lexicon_frequencies(spark):
    df = make_docs(spark, DOCS)
    by_doc = [set(re.findall(r"\w+", t.lower())) for _, t in DOCS]
    want = Counter(w for ws in by_doc for w in ws)
    got = lexicon.word_lexicon(df)
    assert {r.term: r.freq for r in got.collect()} == want
    assert [r.term for r in got.collect()] == sorted(want)
    items = lexicon.word_lexicon(df, frequency="item")
    assert {r.term: r.freq for r in items.collect()} == Counter(w for _, t in DOCS for w in re.findall(r"\w+", t.lower()))


def test_lexicon_slices(spark):
    df = make_docs(spark, DOCS)
    assert [r.term for r in lexicon.word_lexicon(df, start="d").collect()] == ["dog", "the", "über"]
    assert [r.term for r in lexicon.word_lexicon(df, start="d", descending=True).collect()] == ["cat", "42"]
    assert [r.term for r in lexicon.word_lexicon(df, offset=1, limit=2).collect()] == ["cat", "dog"]
    assert [r.term for r in lexicon.word_lexicon(df, pattern="?o*").collect()] == ["dog"]
    assert [r.term for r in lexicon.word_lexicon(df, restrict=F.col("uri") == "/b").collect()] == ["42", "cat", "über"]
    with pytest.raises(ValueError):
        lexicon.word_lexicon(df, frequency="other")


def test_cooccurrence_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(f"/{i}", " ".join(rng.choice("abcde") for _ in range(rng.randrange(6)))) for i in range(60)]
    df = make_docs(spark, rows)
    got = cooccurrence.cooccurrence(df, words(F.col("text")), words(F.upper("text")))
    want = Counter((a, b) for _, t in rows for a in set(t.split()) for b in set(t.split()))
    assert {(r.a, r.b): r.freq for r in got.collect()} == want


@pytest.mark.parametrize("frequency", ["fragment", "item"])
def test_cooccurrence_of_long_arrays(spark, frequency):
    rng = random.Random(5)
    long = [[f"v{rng.randrange(1500)}" for _ in range(n)] + [None] for n in (1300, 900)]
    rows = [("/long", *long), ("/wide", ["v1"], long[0]), ("/null", None, long[0]), ("/none", [], ["v1"]), ("/few", ["v1", "v1"], ["v2", None])]
    df = spark.createDataFrame(rows, "uri string, x array<string>, y array<string>")
    got = cooccurrence.cooccurrence(df, F.col("x"), F.col("y"), frequency=frequency, sort=False).collect()
    once = set if frequency == "fragment" else list
    want = Counter((a, b) for _, x, y in rows if x for a in once(x) if a for b in once(y) if b)
    assert {(r.a, r.b): r.freq for r in got} == want


def test_grid_of_one_document_is_spread(spark):
    values = [str(i) for i in range(5000)]
    both = spark.createDataFrame([(values, values)], "_a array<string>, _b array<string>")
    cells = cooccurrence._grid(both, 96).select(F.spark_partition_id().alias("p"), F.size("_a").alias("a"), F.size("_b").alias("b"))
    by_task = {r.p: r.n for r in cells.groupBy("p").agg(F.sum(F.col("a") * F.col("b")).alias("n")).collect()}
    assert sum(by_task.values()) == 5000 * 5000 and len(by_task) >= 6 and max(by_task.values()) < 5000 * 5000 / 3


@pytest.mark.parametrize("n", [0, 1, 3, 10])
def test_proximity_against_brute_force(spark, n):
    rng = random.Random(n)
    a = [("hot" if rng.random() < 0.5 else f"/{rng.randrange(5)}", rng.randrange(60), rng.choice("xyz")) for _ in range(150)]
    b = [("hot" if rng.random() < 0.5 else f"/{rng.randrange(5)}", rng.randrange(60), rng.choice("pqr")) for _ in range(150)]
    got = cooccurrence.proximity(
        spark.createDataFrame(a, "uri string, pos long, a string"), spark.createDataFrame(b, "uri string, pos long, b string"), n
    )
    want = Counter((x, y) for _, x, y in {(u, x, y) for u, p, x in a for v, q, y in b if u == v and abs(p - q) <= n})
    assert {(r.a, r.b): r.freq for r in got.collect()} == want


def test_query_predicates(spark):
    df = make_docs(spark, [("/1", "Der Hund und die Katze"), ("/2", "Hunde und"), ("/3", "hund -- UND"), ("/4", "Hund die und")])
    def hits(q):
        return sorted(r.uri for r in filters.filter_query(df, q).collect())

    assert hits(filters.word("hund")) == ["/1", "/3", "/4"]
    assert hits(filters.phrase("hund und")) == ["/1", "/3"]
    assert hits(filters.all_of(filters.word("und"), filters.none_of(filters.word("die")))) == ["/2", "/3"]
    assert hits(filters.value("uri", "/2")) == ["/2"]
    assert hits(filters.between("uri", "/2", "/3")) == ["/2", "/3"]


def test_directories_and_scope(spark):
    df = make_docs(spark, [("/a/x", "1"), ("/a/b/y", "2"), ("/ab/z", "3"), ("/a", "4")])
    assert sorted(r.uri for r in filters.filter_directories(df, ["/a"]).collect()) == ["/a/b/y", "/a/x"]
    with pytest.raises(ValueError):
        filters.scope(collections=["c"], directories=["/d"])


def test_selector_leaves_other_types_alone(spark):
    df = make_docs(spark, [("/x", "<m:a xmlns:m='u'><m:b>1</m:b></m:a>")], content_type=F.lit("XML")).unionByName(
        make_docs(spark, [("/t", "no < xml")], content_type=F.lit("TEXT"))
    )
    assert [r.uri for r in filters.filter_selector(df, "/q:a[q:b = 1]").collect()] == ["/x"]


def test_node_operations(spark):
    docs = make_docs(
        spark,
        [("/1", "<a><b i='1'>x</b><!-- c --><b>y</b></a>"), ("/2", "<a/>"), ("/3", "<broken"), ("/4", "<?xml version=\"1.0\"?><a/>")],
        content_type=F.lit("XML"),
    )
    ops = spark.createDataFrame(
        [
            ("/1", "/a/b[1]", "insert-before", "<n>1</n>", 0),
            ("/1", "/a/b[1]", "insert-after", "<n>2</n>", 1),
            ("/1", "//a", "insert-child", "<n>3</n><n>4</n>", 2),
            ("/1", "/a/b[2]", "replace", "<z/>", 3),
            ("/3", "/a", "insert-child", "<n/>", 0),
            ("/4", "/a", "replace", "<c/>", 0),
            ("/none", "/a", "replace", "<c/>", 0),
        ],
        "uri string, path string, op string, xml string, seq int",
    )
    out = {r.uri: r for r in mutate.apply_node_ops(docs, ops).collect()}
    assert out["/1"].text == '<a><n>1</n><b i="1">x</b><n>2</n><!-- c --><z/><n>3</n><n>4</n></a>'
    assert out["/2"].text == "<a/>" and out["/2"].skip_reason is None
    assert out["/3"].text == "<broken" and "ExpatError" in out["/3"].skip_reason
    assert out["/4"].text.endswith("<c/>") and len(out) == 4
    with pytest.raises(Exception, match="unsupported operation"):
        mutate.apply_node_ops(docs, ops.withColumn("op", F.lit("erase"))).collect()


def test_property_operations(spark):
    docs = make_docs(spark, [("/1", "x"), ("/2", "y")])
    ops = spark.createDataFrame([("/1", "k", "old", 0), ("/1", "k", "new", 1), ("/9", "k", "v", 0)], "uri string, name string, value string, seq int")
    once = mutate.apply_property_ops(docs, ops)
    twice = {r.uri: [tuple(p) for p in r.properties] for r in mutate.apply_property_ops(once, ops).collect()}
    assert twice == {"/1": [("k", "new")], "/2": []}
    added = {r.uri: [tuple(p) for p in r.properties] for r in mutate.apply_property_ops(docs, ops, add=True, always_create=True).collect()}
    assert added == {"/1": [("k", "old"), ("k", "new")], "/2": [], "/9": [("k", "v")]}


def test_transform_errors_are_kept(spark):
    def fn(content, context):
        if content["value"] == "bad":
            raise RuntimeError("no")
        return [content, {"uri": content["uri"] + "/2", "value": context["transform_param"]}]

    out = transform.transform_docs(make_docs(spark, [("/1", "ok"), ("/2", "bad")]), fn, param="p").collect()
    assert sorted((r.uri, r.text, r.skip_reason) for r in out) == [("/1", "ok", None), ("/1/2", "p", None), ("/2", "bad", "RuntimeError: no")] or len(out) == 3


def test_rename_elements_keeps_the_rest(spark):
    xml = '<?xml version="1.0"?><m:A Attr="X"><!-- <B> --><B c="D>"/><![CDATA[<E>]]>T</m:A>'
    out = transform.transform_rename_elements(make_docs(spark, [("/1", xml)])).first().text
    assert out == '<?xml version="1.0"?><m:a Attr="X"><!-- <B> --><b c="D>"/><![CDATA[<E>]]>T</m:a>'


def test_redact_elements(spark):
    xml = "<a><s>123-45</s><t><![CDATA[secret 9]]></t><s x='1'>67</s><u>keep 5</u></a>"
    docs = make_docs(spark, [("/1", xml), ("/2", None)], content_type=F.lit("XML"))
    rules = [{"path": "/a/s", "kind": "mask"}, {"path": "//t", "kind": "conceal"}]
    out = {r.uri: r.text for r in redact.redact(docs, rules).collect()}
    assert out == {"/1": '<a><s>###-##</s><s x="1">##</s><u>keep 5</u></a>', "/2": None}
    for bad in ({"column": "text", "kind": "nope"}, {"column": "none", "kind": "mask"}, {"path": "/a/b[@x]", "kind": "mask"}):
        with pytest.raises(ValueError):
            redact.redact(docs, [bad])


def test_custom_reduce_with_a_hot_key(spark):
    rows = skewed()
    df = spark.createDataFrame([(g, v % 100) for g, v, _ in rows], "g string, n long").repartition(5)
    out = transform.custom_reduce_partials(df, ["g"], lambda pdf: pdf.groupby("g", as_index=False).agg({"n": "sum"}), "g string, n long", salts=4)
    want = Counter()
    for g, v, _ in rows:
        want[g] += v % 100
    assert {r.g: r.n for r in out.collect()} == want


def test_counters(spark):
    docs = make_docs(spark, [("/1", "a"), ("/2", "b"), ("/3", "c")]).withColumn("skip_reason", F.when(F.col("uri") == "/1", "bad"))
    failed = spark.createDataFrame([("/2",)], "uri string")
    assert tuple(load_report(docs, 10, failed).first()) == (10, 3, 2, 1, 1)
    watched, seen = observe_load(docs)
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get == {"input_records": 3, "output_records": 2}


def test_broadcast_only_when_small(spark):
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString()

    assert hinted(maybe_broadcast(spark.range(10)))
    assert not hinted(maybe_broadcast(spark.range(10), max_rows=5))
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("x"))
    assert not hinted(maybe_broadcast(wide, max_bytes=5000))


def test_proximity_sends_no_exploded_table_to_the_driver(spark, tmp_path):
    """The files are small, their words are not: the join is shuffled by (uri, block)."""
    spark.range(50).select(F.col("id").alias("uri"), F.lit("a b c " * 200).alias("text")).write.parquet(str(tmp_path / "t"))
    found = spark.read.parquet(str(tmp_path / "t")).select("uri", F.posexplode(F.split("text", " ")).alias("pos", "w")).where("w <> ''")
    near = cooccurrence.proximity(found.select("uri", "pos", F.col("w").alias("a")), found.select("uri", "pos", F.col("w").alias("b")), 1)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert {(r.a, r.b): r.freq for r in near.collect()}[("a", "b")] == 50
