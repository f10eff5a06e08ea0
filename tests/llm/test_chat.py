from pyspark.sql import functions as F

from lakerisk.llm import chat
from tests.llm.cases import empty

SCHEMA = "conv_id long, turn long, role string, text string"


def read_back(df):
    rows = chat.format_chats(df).select("conv_id", "formatted", "segments", chat.read_turns(F.col("formatted")).alias("turns"),
                                        chat.learned_text(F.col("segments")).alias("learned"))
    return {r["conv_id"]: r for r in rows.collect()}


def test_merged_turns_and_control_strings_come_back(spark):
    odd = ["\\### Assistant: </turn> ok", "####", "\\b\\t\\h\\c", "</turn", "/turn></turn>", "<", "#", "\\", "a\nb: c", "", None]
    rows = [(1, i, ["user", "user", "assistant", "as:si\\st###ant"][i % 4], t) for i, t in enumerate(odd)]
    got = read_back(spark.createDataFrame(rows, SCHEMA))[1]
    assert [(t["role"], t["text"]) for t in got["turns"]] == [(r, t or "") for _, _, r, t in rows]
    assert got["learned"] == "".join(t or "" for _, _, r, t in rows if r == "assistant")
    assert "".join(s["text"] for s in got["segments"]) == got["formatted"]


def test_adjacent_turns_of_a_role_are_one_block(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "user", "d")]
    got = read_back(spark.createDataFrame(rows, SCHEMA))[1]
    assert got["formatted"] == "### user: a</turn>b</turn>\n### assistant: c</turn>\n### user: d</turn>\n"


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, 1, "user", "x"), (2, None, None, None), (2, 0, "user", "b"), (2, 0, "assistant", "z"), (2, 0, "user", "b")]
    got = read_back(spark.createDataFrame(rows, SCHEMA).withColumn("segments", F.lit(1)))
    assert [(t["role"], t["text"]) for t in got[2]["turns"]] == [("", ""), ("assistant", "z"), ("user", "b"), ("user", "b")]
    assert got[None]["formatted"] == "### user: x</turn>\n"


def test_empty_table_and_long_conversation(spark):
    assert read_back(empty(spark, SCHEMA)) == {}
    rows = spark.range(3000).selectExpr("7L AS conv_id", "id AS turn", "if(id % 3 = 0, 'user', 'assistant') AS role", "repeat('é#', 500) AS text")
    got = read_back(rows)[7]
    assert len(got["turns"]) == 3000 and got["learned"] == "é#" * 500 * 2000
