import random
import re

import pytest

from docspark.llm import jaccard


def brute(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, len(s), least.get(root(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def run(df):
    return sorted((tuple(r)[:3] for r in jaccard.jaccard_components(df).collect()), key=str)


def brute_links(rows):
    out = []
    for a, (i, text) in enumerate(rows):
        mine = shingle_set(text)
        out.append((i, sum(b != a and bool(mine) and 100 * len(mine & o) >= 75 * len(mine | o) for b, o in enumerate(map(shingle_set, (t for _, t in rows))))))
    return sorted(out, key=str)


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def links(df):
    return sorted(((r["doc_id"], r["n_links"]) for r in jaccard.jaccard_components(df).collect()), key=str)


def test_links_of_every_row(table, hostile, words, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 3)
    monkeypatch.setattr(jaccard, "COLUMNS", 50)
    rows = corpus(words, 7) + [(r["doc_id"], r["text"]) for r in hostile.collect()]
    rows += [(5000 + k, rows[k % 9][1]) for k in range(40)]
    assert links(table(rows)) == brute_links(rows)


def test_links_of_a_dense_group(table, words):
    base, rows = words(5, 200).split(), []
    for k in range(90):
        copy = list(base)
        for j in range(1 + k % 5):
            copy[(37 * j + 7 * k) % 200] = f"own{k}"
        rows.append((k, " ".join(copy)))
    want = brute_links(rows)
    assert links(table(rows)) == want and 0 < min(n for _, n in want) and {n for _, n in want} != {89}


def corpus(words, seed=1):
    rng, rows = random.Random(seed), []
    passage = words(99, 40)
    for k in range(25):
        base = words(k, rng.choice([3, 5, 8, 30, 120])).split()
        rows.append((len(rows), " ".join(base)))
        for _ in range(rng.choice([0, 1, 4])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = "changed"
            rows.append((len(rows), " ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy)))
        rows.append((len(rows), f"{passage} {words(1000 + k, 12)}"))
    rng.shuffle(rows)
    return rows


def test_against_brute_force(table, words):
    rows = corpus(words)
    assert run(table(rows)) == brute(rows)


def test_dense_group_is_joined_without_all_pairs(table, words):
    base, rows = words(5, 200).split(), []
    for k in range(120):
        copy = list(base)
        copy[k] = f"own{k}"
        rows.append((k, " ".join(copy)))
    assert run(table(rows)) == brute(rows)


def test_frequent_shingles_have_shards_of_their_own(table, words, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 1)
    monkeypatch.setattr(jaccard, "LEAST_FREQUENT", 5)
    monkeypatch.setattr(jaccard, "LIST", 3)
    rows = corpus(words, 2)
    assert run(table(rows)) == brute(rows)


def test_hostile_rows(hostile):
    rows = [(r["doc_id"], r["text"]) for r in hostile.collect()]
    assert run(hostile) == brute(rows)


def test_empty_table(hostile):
    assert run(hostile.limit(0)) == []
    assert jaccard.keep_first(hostile.limit(0)).count() == 0


def test_threshold_is_exact(table):
    # 7 words make 3 shingles; with one of 4 different the sets share 3 of 4, with one of 3 two of 3
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g h"), (3, "p q r s t u"), (4, "p q r s t u v")]
    assert run(table(rows)) == [(1, 3, 1), (2, 4, 1), (3, 2, 3), (4, 3, 4)]


def test_keep_first(table, words):
    a = words(1, 50)
    rows = [(9, a), (4, a), (4, a), (7, words(2, 50)), (None, a), (8, "")]
    kept = jaccard.keep_first(table(rows))
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == [(False, 4), (False, 7), (False, 8), (True, None)]
    assert kept.columns == table(rows).columns


def test_components(spark):
    rng = random.Random(0)
    edges = [(a, a + 1) for a in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["node"]: r["component"] for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in linked}


@pytest.mark.parametrize("lists", [[], [[1, 2, 3]], [[1, 3], [1, 2, 3], [3]]])
def test_heap_merge(lists):
    flat = [x for one in lists for x in one]
    assert list(jaccard.heap_merge(lists)) == sorted((x, flat.count(x)) for x in set(flat))


def test_no_text_beside_the_scans(table, words):
    df = table(corpus(words))
    plan = jaccard.jaccard_components(df)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_keep_first_goes_by_rows(table, words):
    a, b, c = (words(k, 50) for k in (1, 2, 3))
    rows = [(5, a), (5, b), (3, a), (6, c), (6, c), (7, ""), (7, ""), (7, "x"), (None, b), (None, c), (None, c)]
    for parts in (1, 4):
        kept = jaccard.keep_first(table(rows).repartition(parts))
        got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
        assert got == sorted([(3, a), (5, b), (6, c), (7, ""), (7, "x"), (None, b), (None, c), (None, c)], key=str)
