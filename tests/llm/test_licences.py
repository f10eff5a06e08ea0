import random
import re

import pytest

from lakerisk.llm import licences
from tests.llm.cases import awkward, empty, lower


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    found = []
    for label, phrase in licences.PHRASES:
        p = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def test_phrases_against_a_plain_search(spark):
    random.seed(4)
    pool = "gnu general public license apache cc by mit the License, MIT-License GNU (general) public cc_by é by1".split()
    texts = {i: " ".join(random.choices(pool, k=random.randint(0, 40))) for i in range(150)}
    rows = licences.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    got = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in rows}
    assert got == {i: plain(t) for i, t in texts.items()}
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in rows)


def test_notices_with_words_more_or_less(spark):
    mit = "Permission is hereby granted free of charge, to any natural person obtaining a copy of this software and associated documentation files"
    scattered = " x ".join(mit.split())
    rows = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame([(1, "foo " + mit + " bar"), (2, scattered)], "doc_id long, text string")).collect()}
    assert rows[1]["labels"] == "mit" and rows[1]["base_labels"] == "" and rows[1]["n_base"] == 0 and 0.8 <= rows[1]["score"] < 1
    assert [(f["first"], f["last"]) for f in rows[1]["found"]] == [(1, 21)]
    assert rows[2]["labels"] == "" and rows[2]["score"] == 0


@pytest.mark.parametrize("n", [65, 66, 100, 300])
def test_a_notice_of_any_length(spark, n):
    notice = " ".join(f"w{i}" for i in range(n))
    texts = [(1, "before " + notice + " after"), (2, notice.replace(f" w{n // 2} ", " ")), (3, notice.split(f" w{n // 2} ")[0])]
    df = spark.createDataFrame(texts + texts[:1], "doc_id long, text string")
    got = {r["doc_id"]: r for r in licences.scan(df, notices=[("long", notice)]).collect()}
    assert got[1]["labels"] == "long" and got[1]["score"] == 1.0
    assert got[2]["labels"] == "long" and 1 - 3 / n < got[2]["score"] < 1
    assert got[3]["labels"] == ""


def test_awkward_rows(spark):
    rows = licences.scan(awkward(spark)).collect()
    got = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert len(rows) == 12  # the repeated row is one document
    assert got[2]["n_words"] == got[3]["n_words"] == 0 and got[2]["labels"] == ""
    assert got[-3]["labels"] == "cc-by,cc-by-nc" and got[-3]["first_word"] == 2


def test_no_python_in_the_plan(spark):
    plan = licences.scan(awkward(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_empty_table(spark):
    assert licences.scan(empty(spark)).count() == 0
