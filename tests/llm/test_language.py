from docspark.llm import language


def data(words):
    other = lambda k: " ".join("ß" + w[::-1] + "ü" for w in words(k, 40).split())
    rows = [(k, words(k, 40), "en") for k in range(0, 120, 2)] + [(k, other(k), "de") for k in range(1, 120, 2)]
    return rows, other


def test_held_out_accuracy(table, words):
    rows, _ = data(words)
    df = table(rows)
    model = language.fit(df.filter(~language.held_out()))
    got = {r["doc_id"]: r for r in language.identify(df, model).collect()}
    tested = [k for k, _, _ in rows if language.crc_fold(k)]
    assert tested and all(got[k]["lang_pred"] == lang for k, _, lang in rows if k in tested)
    assert not any(r["rejected"] for r in got.values())
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_held_out_rule(table):
    got = {r["doc_id"]: r["h"] for r in table([(k, "") for k in (*range(50), -3)]).select("doc_id", language.held_out().alias("h")).collect()}
    assert got == {k: language.crc_fold(k) for k in (*range(50), -3)}


def test_far_texts_are_rejected(table, words):
    rows, _ = data(words)
    model = language.fit(table(rows))
    names, scores, far = model.predict(["мир труд май весна и ещё много слов о другом " * 8, words(3, 40), None, "", "12 34 !?"])
    assert far.tolist() == [True, False, True, True, True]
    assert names[2:] == ["und"] * 3 and names[0] in ("en", "de") and scores[2:].tolist() == [0, 0, 0]


def test_lang_source_and_id_are_no_inputs(table, words):
    rows, _ = data(words)
    model = language.fit(table(rows))
    other = table([(k + 1000, t, "zz", "other") for k, t, _ in rows])
    pick = lambda df: sorted((r["lang_pred"], r["score"]) for r in language.identify(df, model).collect())
    assert pick(table(rows)) == pick(other)


def test_hostile_and_empty(hostile):
    model = language.fit(hostile)
    got = language.identify(hostile, model).collect()
    assert len(got) == hostile.count()
    assert all(r["lang_pred"] == "und" and r["rejected"] for r in got if r["doc_id"] in (1, 2, 3))
    empty = hostile.limit(0)
    none = language.fit(empty)
    assert none.langs == [] and language.identify(empty, none).count() == 0
    assert {r["lang_pred"] for r in language.identify(hostile, none).collect()} == {"und"}
    assert language.keep_identified(hostile).columns == hostile.columns


def test_long_text_is_read_whole():
    a, b = language.counts("ab " * 300_000), language.counts("ab " * 150_000)
    assert (a >= b).all() and a.sum() > 1.9 * b.sum()
