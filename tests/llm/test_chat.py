import duckdb

from docspark.llm import chat
from tests.compare import compare

ROWS = [
    (1, 0, "user", "same question"),
    (1, 1, "assistant", "one answer"),
    (1, 2, "user", "more?"),
    (2, 0, "user", "same question"),
    (2, 1, "assistant", "another answer"),
    (3, 0, "system", "be brief"),
    (3, 1, "user", "zzz"),
    (3, 2, "assistant", "a"),
    (4, 0, "system", "be brief"),
    (4, 1, "user", "zzz"),
    (4, 2, "assistant", "a"),
    (4, 3, "user", None),
    (5, 7, None, "\U0001f600 last"),
    (5, 7, None, "\U0001f600 last"),
    (None, 0, "user", "no conversation"),
]
KINDS = "conv_id long, turn long, role string, text string, side string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], KINDS)


def test_against_sql(spark, tmp_path):
    df = frame(spark, ROWS)
    df.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}).to_parquet(tmp_path / "c.parquet")
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/c.parquet'")
    assert compare(chat.neighbour_preferences(df), con, chat.ORACLE) is None


def test_pairs_as_rows(spark):
    turns = chat.indexed(frame(spark, ROWS))
    pairs = spark.createDataFrame([(10, 1, 2), (11, 3, 4), (12, 5, None)], "pair_id long, chosen_id long, rejected_id long")
    got = {r["pair_id"]: r for r in chat.assembled(chat.preferences(turns, pairs)).collect()}
    a = got[10]
    assert a["prompt"] == "<|user|>\nsame question<|end|>\n"
    assert a["chosen"] == "<|assistant|>\none answer<|end|>\n<|user|>\nmore?<|end|>\n"
    assert a["rejected"] == "<|assistant|>\nanother answer<|end|>\n"
    assert [a["chosen"][s["start"] : s["end"]] for s in a["chosen_loss"]] == ["<|assistant|>\none answer<|end|>\n"]
    b = got[11]
    assert b["chosen"] == "" and b["rejected"] == "<|user|>\n<|end|>\n" and b["rejected_loss"] == []
    assert b["prompt"].count("<|end|>") == 3
    assert got[12]["prompt"] == "" and got[12]["chosen"] == "<||>\n\U0001f600 last<|end|>\n" * 2


def test_empty(spark):
    assert chat.neighbour_preferences(frame(spark, [])).count() == 0
    assert chat.neighbour_preferences(frame(spark, [(None, 1, "user", "x")])).count() == 0


def test_long_conversation_is_not_gathered(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", f"turn {k}") for k in range(3000)] + [(2, k, "user" if k % 2 else "assistant", f"turn {k}") for k in range(2900)]
    got = chat.neighbour_preferences(frame(spark, rows))
    assert got.filter("part = 'prompt'").count() == 2900
    last = got.filter("part = 'chosen'").orderBy("idx").collect()
    assert len(last) == 100 and last[0]["start"] == 0 and last[-1]["start"] == sum(r["length"] for r in last[:-1])
