import random

from lakerisk.llm import lines
from tests.llm.cases import AWKWARD, awkward, empty, kept_lines


def by_id(df):
    return {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect()}


def test_against_a_plain_version_with_compaction(spark):
    random.seed(2)
    pool = [f"line number {i} of the pool" for i in range(30)] + ["short", "", "\tLine Number 3 of the pool ", "ÄÖÜ ÄÖÜ ÄÖÜ", "äöü äöü äöü", "éééééééééé"]
    texts = {i: "\n".join(random.choices(pool, k=random.randint(0, 9))) for i in random.sample(range(1000), 120)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert by_id(lines.dedup_lines(docs, batches=7, fanout=2)) == kept_lines(texts)
    assert by_id(lines.dedup_lines(docs, batches=1)) == kept_lines(texts)


def test_awkward_rows(spark):
    out = lines.dedup_lines(awkward(spark))
    rows = out.collect()
    assert len(rows) == len(AWKWARD) and {"lang", "score", "_text", "key"} <= set(out.columns)
    got = {r["doc_id"]: r for r in rows}
    assert (got[2]["n_lines"], got[2]["n_dropped"], got[2]["text"]) == (1, 0, "")
    assert got[1]["n_dropped"] == 0 and got[6]["n_dropped"] == 2 and got[6]["text"] == ""
    assert [r["text"] for r in rows if r["doc_id"] is None and r["text"]] == ["no id here, but a text of some words"]
    assert got[8]["text"] == dict((r[0], r[1]) for r in AWKWARD)[8]


def test_empty_table(spark):
    assert lines.dedup_lines(empty(spark)).count() == 0


def test_rows_of_a_hot_id_do_not_share_an_array(spark, monkeypatch):
    """Without an id, or with one id, a row meets the dropped lines of its own text only."""
    original = lines._without

    def checked(min_chars, columns):
        run = original(min_chars, columns)

        def watch(batches):
            for batch in batches:
                for text, gone in zip(batch.column("_text").to_pylist(), batch.column("_gone").to_pylist()):
                    assert len(gone or []) <= len((text or "").split("\n"))
                yield batch

        return lambda batches: run(watch(batches))

    monkeypatch.setattr(lines, "_without", checked)
    texts = ["\n".join(f"a line with number {3 * i + k}" for k in range(3)) for i in range(40)]
    rows = [(1, "\n".join(texts))] + [(None, t) for t in texts] + [(5, t) for t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lines.dedup_lines(docs).collect()
    assert len(got) == 81 and all(r["n_dropped"] == (0 if r["doc_id"] == 1 else 3) for r in got)


def test_the_largest_id_is_not_a_missing_one(spark):
    line = "a line that all of them hold"
    rows = [(2**63 - 1, line), (None, line), (None, line + "\nanother line of text"), (2**63 - 1, "another line of text")]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["text"]) for r in got} == {(2**63 - 1, line), (None, ""), (2**63 - 1, "another line of text")}
    assert sum(r["n_dropped"] for r in got) == 3
