import re
from collections import Counter

import numpy as np

from docspark.llm import boosting, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    runs = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = {k + i for k in range(len(w) - 7) if runs[tuple(w[k : k + 8])] > 1 for i in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def test_statistics_against_brute_force(table, hostile, words):
    texts = [words(k, 60) + "\n" + words(k % 3, 9) + "\n" + words(k % 2, 30) + "\n" + words(k % 3, 9) + " ###|" for k in range(20)]
    df = table([(k, t) for k, t in enumerate(texts)]).unionByName(hostile)
    got = quality.judge(df, quality.fit(df.limit(0), df.limit(0).selectExpr("doc_id", "1 as quality")))
    rows = {(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got.collect()}
    assert rows == {(r["doc_id"], *brute(r["text"])) for r in df.collect()}
    assert all(r["kept"] != r["base_failed"] for r in got.collect())  # without labels the base rule decides


def test_trees_keep_good_texts(table, words):
    good = [(k, words(k, 80)) for k in range(60)]
    bad = [(100 + k, " ".join(w + "###" for w in words(k, 80).split())) for k in range(60)]
    df = table(good + bad)
    labels = df.selectExpr("doc_id", "cast(doc_id < 100 as int) as quality", "0 as toxic")
    verdict = quality.fit(df, labels)
    fresh = table([(k, words(500 + k, 90)) for k in range(20)] + [(100 + k, words(600 + k, 90).replace(" ", "### ")) for k in range(20)])
    assert {r["doc_id"]: r["kept"] for r in quality.judge(fresh, verdict).collect()} == {**{k: True for k in range(20)}, **{100 + k: False for k in range(20)}}


def test_monotone_and_flat_forest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    y = (np.sin(3 * x[:, 0]) + x[:, 1] + 0.3 * rng.normal(size=2000) > 0).astype(float)
    forest = boosting.train(x, y, {0: 1, 1: 1}, trees=40)
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.75
    for f in (0, 1):
        rows = np.repeat(rng.normal(size=(50, 3)), 30, axis=0)
        rows[:, f] = np.tile(np.linspace(-3, 3, 30), 50)
        assert (np.diff(forest.margin(rows).reshape(50, 30), axis=1) >= -1e-9).all()
    # one row at a time, node by node
    for row in x[:20]:
        total = forest.base
        for t in range(len(forest.feature)):
            node = 0
            for _ in range(forest.depth):
                node = 2 * node + 1 + int(row[forest.feature[t, node]] > forest.threshold[t, node])
            total += forest.value[t, node]
        assert abs(total - forest.margin(row[None])[0]) < 1e-9


def test_one_label_or_none():
    assert boosting.train(np.zeros((0, 2)), np.zeros(0)).probability(np.zeros((3, 2))).tolist() == [0.5] * 3
    assert (boosting.train(np.zeros((4, 2)), np.ones(4)).probability(np.zeros((1, 2))) > 0.99).all()


def test_one_text_of_a_repeated_id_is_learned_from(spark, table, words):
    rows = [(k, words(k, 40 + k)) for k in range(40)] + [(100 + k, words(k, 60).replace(" ", " ### ")) for k in range(40)]
    labels = table(rows).selectExpr("doc_id", "cast(doc_id < 100 as int) as quality", "0 as toxic")
    many = rows + [(7, words(900 + k, 50)) for k in range(300)] + [(None, "no id")]
    first, second = quality.fit(table(many), labels), quality.fit(table(many[::-1]).repartition(5), labels)
    assert first.least == second.least and (first.forest.value == second.forest.value).all()
    hot = quality.fit(table(many + [many[90]] * 300), labels)
    assert first.least == hot.least and (first.forest.value == hot.forest.value).all()
