import re
from collections import Counter, defaultdict

import numpy as np

from docspark.llm import divergence


def brute(rows):
    rows = [(r[1] or "", r[2] or "", r[3] or "") for r in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(lower))
        n[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in docs:
        kept = [t for t, d in docs[lang].items() if d >= 10]
        sources = [s for g, s in n if g == lang]
        whole = Counter()
        for s in sources:
            whole.update({t: n[lang, s][t] for t in kept})

        def share(counts, t):
            return 1 + 10**9 * (counts[t] + 2) // (sum(counts[x] for x in kept) + 2 * len(kept))

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        for s in sources:
            pairs = [(-sum(f(share(n[lang, s], t), share(n[lang, o], t)) for t in kept), o.encode()) for o in sources if o != s]
            marks = [(-f(share(n[lang, s], t), share(whole, t)), t.encode()) for t in kept if n[lang, s][t] and share(n[lang, s], t) > share(whole, t)]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(marks)[:10])):
                out += [(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(items, 1)]
    return sorted(out)


def corpus(words, seed=1):
    pool = words(seed, 25).split()
    rows = []
    for k in range(160):
        text = " ".join(pool[(k * j + j * j) % (5 + k % 20)] for j in range(k % 40)) + [" É中 A_b9c", "", " x" * (k % 5)][k % 3]
        rows.append((k, text, [None, "", "en", "de"][k % 4], [None, "a", "b", "é", "\U0001f600"][k % 5]))
    return rows + [(900, "Lone", "xx", "only"), (901, "", "yy", "one"), (902, None, "yy", "two")]


def run(df):
    out = divergence.audit(df)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, out.collect()))


def test_against_brute_force(table, words):
    rows = corpus(words)
    assert run(table(rows).repartition(3)) == brute(rows)


def test_blocks_tiles_pieces_and_flushes(table, words, monkeypatch):
    for name, value in (("TERMS", 3), ("TILE", 4), ("HELD", 20), ("PIECE", 5)):
        monkeypatch.setattr(divergence, name, value)
    rows = corpus(words, 2)
    assert run(table(rows)) == brute(rows)


def test_hostile_rows(hostile):
    rows = [tuple(r) for r in hostile.collect()]
    assert run(hostile) == brute(rows)
    assert run(hostile.limit(0)) == []
    many = [tuple(r) for r in hostile.collect()] * 12
    assert run(hostile.sparkSession.createDataFrame(many, hostile.schema)) == brute(many)


def test_joint_tables():
    counts = np.random.default_rng(0).integers(0, 4, (50, 6))
    got = Counter()
    for a, x, b, y, cells in divergence.joint(counts):
        for cell in zip(a.tolist(), x.tolist(), b.tolist(), y.tolist(), cells.tolist(), strict=True):
            got[cell[:4]] += cell[4]
    want = Counter()
    for row in counts.tolist():
        want.update((a, row[a], b, row[b]) for a in range(6) for b in range(a, 6))
    assert got == want


def test_terms_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 3)
    text = "Ab  c9dÉé_中文z! long-word" + "q" * 50
    assert [t.decode() for some in divergence.terms(text.encode()) for t in some] == ["ab", "c", "dÉé", "中文z", "long", "word" + "q" * 50]
