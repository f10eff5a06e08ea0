import hashlib
import random
import re
from itertools import product

import pytest

from lakerisk.llm import queries, repair
from tests.compare import assert_same

SCHEMA = "conv_id long, turn long, role string, text string"
PATTERN = re.compile(r"(s?(ua)+)?")


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain(rows):
    """Cost, audit and turns by trying all edits, with at most three insertions in a place."""
    found, best = faults(rows), None
    gaps = [g for n in range(4) for g in product(("user", "assistant"), repeat=n)]

    def go(i, cost, letters, written):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        for gap in gaps:
            now, text = written + [(r, "") for r in gap], letters + "I" * len(gap)
            paid = cost + 2 * len(gap)
            if i == len(rows):
                if PATTERN.fullmatch("".join(r[:1] for r, _ in now)):
                    best = min(best or (paid, text, now), (paid, text, now))
                continue
            role, body = rows[i][1:]
            cut = found[i] == "truncated"
            go(i + 1, paid + 3, text + "D", now)
            if found[i] not in ("blank", "duplicate"):
                if role[:1] in ("s", "u", "a"):
                    go(i + 1, paid + cut, text + "K", now + [(role, body)])
                for new in ("user", "assistant"):
                    go(i + 1, paid + 2 + cut, text + "R", now + [(new, body)])

    go(0, 0, "", [])
    return best


def test_cheapest_edits_against_all_edits():
    random.seed(5)
    for _ in range(60):
        rows = [(i, random.choice(["system", "user", "assistant", "tool", "u", ""]), random.choice(["", "x.", "y", f"z{i}!"])) for i in range(random.randint(0, 3))]
        of = {"blank": repair.DROPPED, "duplicate": repair.DROPPED, "truncated": repair.TRUNCATED, "": repair.SOUND}
        codes = bytes(repair.code(r[1][:1], of[f]) for r, f in zip(rows, faults(rows)))
        assert repair.cheapest(codes) == plain(rows)[:2], rows


def forward(codes):
    """The same optimum by a forward pass that keeps whole audits, without checkpoints."""
    best = {repair.START: (0, "")}
    for row in [*codes, None]:
        for _ in range(2):
            for state in list(best):
                cost, text = best[state]
                to = repair.NEXT[state]
                best[to] = min(best.get(to, (1 << 60, "")), (cost + 2, text + "I"))
        if row is None:
            return min(best[s] for s in (repair.START, repair.ASSISTANT) if s in best)
        kept, stays, extra = repair._stays(row)
        after = {}
        for state, (cost, text) in best.items():
            moves = [(state, cost + 3, "D")]
            if stays:
                moves += [(repair.NEXT[state], cost + 2 + extra, "R")] + ([(kept[state], cost + extra, "K")] if state in kept else [])
            for to, paid, letter in moves:
                after[to] = min(after.get(to, (1 << 60, "")), (paid, text + letter))
        best = after


@pytest.mark.parametrize("n", [1, 2, 3, 8, 9, 10, 99, 100, 101, 700])
def test_blocks_give_the_same_path_at_any_length(n):
    random.seed(n)
    for _ in range(20):
        codes = bytes(random.randrange(12) for _ in range(n))
        assert repair.cheapest(codes) == forward(codes)


ROWS = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."),
    (2, None, "system", "Be good."), (2, 5, "user", "a"), (2, 9, "assistant", None), (2, 9, "assistant", "x!"),
    (3, 0, "assistant", " \t\n"), (3, 0, "assistant", " \t\n"),
    (4, 2**63 - 1, "user", "y?"), (4, -2**63, "user", "y?"),
    (5, 0, None, "Who?"), (5, 1, "", "Me."), (5, 2, "tool", "z."),
    (None, 1, "user", "no id."), (None, 2, "user", "no id."), (None, 1, "user", "no id."),
    (6, None, "user", "x" * 200_000 + "."),
]


def expected(rows):
    """Audit row of a conversation of ``turn, role, text`` by the plain version."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    found, turns = faults(rows), [t for t, _, _ in rows if t is not None]
    cost, letters, written = plain(rows)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = min(max(turns) - min(turns) + 1 - len(set(turns)), 2**63 - 1) if turns else 0
    return (gaps, *[found.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, letters), written


def test_awkward_rows_against_the_plain_version(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "'x' AS kind", "'y' AS digest", "'z' AS audit")
    audits = repair.audit(df)
    turns = repair.repaired(df, audits).collect()
    got = {r["conv_id"]: r for r in audits.collect()}
    assert set(got) == {r[0] for r in ROWS}
    for key in got:
        want, written = expected([r[1:] for r in ROWS if r[0] == key])
        assert tuple(got[key])[1:] == want
        assert [(t["role"], t["text"]) for t in sorted((t for t in turns if t["conv_id"] == key), key=lambda t: t["place"])] == written


def test_long_conversation_and_empty_table(spark):
    rows = [(7, i, ("user", "assistant")[(i // 2) % 2], f"t{i % 911}.") for i in range(5_000)]
    found = repair.audit(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 1 and found[0]["duplicate"] > 0 and found[0]["audit"].replace("I", "").__len__() == 5_000
    none = spark.createDataFrame([], SCHEMA)
    assert repair.audit(none).collect() == [] and repair.repaired(none, repair.audit(none)).collect() == []


def test_one_shuffle_of_texts(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    plan = repair.audit(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(conv_id") == 1 and plan.count("Exchange ") == 1


def test_made_faults_against_sql(spark, con, tmp_path):
    """Null keys, dropped conversations and ties through the whole query."""
    rows = ROWS[:13] + [(i, None if i % 7 == 0 else i % 5, "user" if i % 3 else None, "word. " * (i % 4)) for i in range(100, 260)]
    spark.createDataFrame([(a, b, c, d) for a, b, c, d in rows if b is None or abs(b) < 2**62], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    con.execute(f"CREATE OR REPLACE TEMP VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    try:
        assert_same(queries.op11_conversation_repair(spark, str(tmp_path)), con, queries.OP11_SQL)
    finally:
        con.execute("DROP VIEW temp.conversations")
