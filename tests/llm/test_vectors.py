import hashlib
import math
import random

import numpy as np
import pytest

from docspark.llm import pstable, subvectors

ODD = [
    (100, None, 1, "x"),
    (101, [], 1, "x"),
    (102, [0.0] * 64, 1, "x"),
    (103, [None] + [1.0] * 63, 1, "x"),
    (104, [float("nan")] + [1.0] * 63, 1, "x"),
    (105, [float("inf")] + [1.0] * 63, 1, "x"),
    (106, [1.0] * 63, None, None),
    (107, [1.0] * 65, None, None),
    (None, [0.5] * 64, None, None),
    (108, [0.5] * 64, None, None),
    (108, [0.5] * 64, None, None),
    (109, [-0.0] * 63 + [2.5], None, None),
    (109, [0.0] * 63 + [1.25], None, None),
]
SCHEMA = "vec_id long, embedding array<float>, cls int, body string"


def clouds(n, seed=0, dims=64, spread=0.02):
    """Vectors around a few points, in single precision, with exact copies."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((max(2, n // 8), dims))
    rows = centres[rng.integers(len(centres), size=n)] + rng.standard_normal((n, dims)) * spread * rng.integers(0, 16, (n, 1))
    return [(i, [float(x) for x in row.astype(np.float32)], i % 3, "x") for i, row in enumerate(rows)]


def kept(rows):
    return [(i, v) for i, v, *_ in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]


def brute_clusters(rows):
    rows = [(i, [math.floor(1024 * x) for x in v]) for i, v in kept(rows)]
    named = [(i is None, hashlib.sha256(f"3:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in rows]
    centroids = [v for *_, v in sorted(named)[:8]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(10):
        of = [nearest(v)[1] for _, v in rows]
        for k in range(len(centroids)):
            own = [v for (_, v), c in zip(rows, of, strict=True) if c == k]
            if own:
                centroids[k] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    last = [nearest(v) for _, v in rows]
    inertia = {k: sum(d for d, c in last if c == k) for k in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for (i, _), (d, c) in zip(rows, last, strict=True)), key=str)


@pytest.mark.parametrize("rows", [clouds(150), clouds(40, 1) + ODD, clouds(5, 2), ODD, [], [clouds(3)[0]] * 20 + clouds(30, 3)])
def test_clusters_against_brute_force(spark, rows):
    got = subvectors.cluster(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_clusters(rows)


def test_clusters_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(subvectors, "CHUNK", 7)
    rows = clouds(100, 4)
    assert sorted(map(tuple, subvectors.cluster(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()), key=str) == brute_clusters(rows)


@pytest.mark.parametrize("width", [1, 2, 3, 64])
def test_encoding_loses_nothing(width):
    rng = np.random.default_rng(width)
    vectors = rng.integers(-3, 3, (200, 64))
    entries, codes = subvectors.encode(vectors, width)
    assert (subvectors.decode(entries, codes) == vectors).all()
    assert all(len(np.unique(e, axis=0)) == len(e) for e in entries)
    # a distance is that of the vector itself
    centroids = rng.integers(-3, 3, (8, 64))
    cluster, distance = subvectors.nearest(entries, codes, centroids, len(vectors))
    direct = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (cluster == direct.argmin(axis=1)).all() and (distance == direct.min(axis=1)).all()
    assert (subvectors.sums(entries, codes, cluster, 8) == [vectors[cluster == k].sum(axis=0) for k in range(8)]).all()


def test_clusters_refuse_what_does_not_fit(spark):
    with pytest.raises(Exception, match="64 bits"):
        subvectors.cluster(spark.createDataFrame([(1, [1e30] * 64, 0, "")], SCHEMA)).collect()


def brute_links(rows):
    """(vec_id, links, component, kept) of every row, and the number of links."""
    units = []
    for _, v, *_ in rows:
        fine = v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        v = np.array(v, np.float32).astype(float) if fine else None
        units.append(v / np.linalg.norm(v) if fine else None)
    linked = [
        [b for b in range(len(rows)) if b != a and u is not None and units[b] is not None and len(u) == len(units[b]) and u @ units[b] >= 0.95]
        for a, u in enumerate(units)
    ]
    seen, out = {}, []
    for a in range(len(rows)):
        if a not in seen:
            group, todo = {a}, [a]
            while todo:
                todo = [b for x in todo for b in linked[x] if b not in group]
                group.update(todo)
            ids = [rows[x][0] for x in group if rows[x][0] is not None]
            seen |= dict.fromkeys(group, min(ids, default=None))
        out.append((rows[a][0], len(linked[a]), seen[a], rows[a][0] == seen[a]))
    return sorted(out, key=str)


def links(spark, rows, schema=SCHEMA):
    got = pstable.near_vectors(spark.createDataFrame(rows, schema).repartition(3))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("rows", [clouds(200, 5), clouds(60, 6) + ODD, ODD, []])
def test_links_against_brute_force(spark, rows):
    # so few vectors share one key of one projection in many tables: nothing is missed
    assert links(spark, rows) == brute_links(rows)


def test_links_of_wide_buckets_in_cells(spark, monkeypatch):
    monkeypatch.setattr(pstable, "CELL", 8)
    rows = clouds(150, 7, spread=0.01)
    rng = random.Random(7)
    rows += [(1000 + k, rows[rng.randrange(5)][1], 0, "") for k in range(60)]
    assert links(spark, rows) == brute_links(rows)


def test_links_of_doubles_and_mixed_lengths(spark):
    rows = [(i, v[: 64 - 32 * (i % 2)]) for i, v, *_ in clouds(80, 8)] + [(500, [1e300, 0.0]), (501, [1e-300, 0.0]), (502, [0.0, -1e-300])]
    got = {r[0]: r[1:] for r in links(spark, rows, "vec_id long, embedding array<double>")}
    assert got[500] == (1, 500, True) and got[501] == (1, 500, False) and got[502] == (0, 502, True)


def test_recall_of_links_with_many_projections(spark, monkeypatch):
    """Keys as long as those of 10^7 vectors: found links are right, and 0.97 of them or more are found."""
    monkeypatch.setattr(pstable, "LOAD", 1e-4)
    assert pstable.shape(600)[0] > 15
    rows = clouds(600, 9, spread=0.012)
    want, got = {r[0]: r for r in brute_links(rows)}, links(spark, rows)
    assert all(n <= want[i][1] for i, n, *_ in got)
    assert sum(n for _, n, *_ in got) >= 0.97 * sum(n for _, n, *_ in want.values())


def test_recall_on_the_given_vectors(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    rows = [tuple(r) for r in df.collect()]
    assert sorted(map(tuple, pstable.near_vectors(df).collect()), key=str) == brute_links(rows)


def test_shape_keeps_the_recall():
    near = pstable.meet(math.sqrt(0.1))
    for n in (0, 1, 10, 10**4, 10**7, 10**10):
        k, tables = pstable.shape(n)
        assert 1 - (1 - near**k) ** tables >= pstable.RECALL
        assert n * pstable.meet(math.sqrt(2)) ** k <= pstable.LOAD
