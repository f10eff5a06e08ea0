"""Repair of conversation structure with the cheapest edits.

A conversation is to have role initials of the form ``(s?(ua)+)?``: an optional system turn, then user and
assistant in turns, the assistant last; or no turn at all. Its rows, in the order of their turns, may be kept
(K, free), given the role user or assistant (R, 2), or deleted (D, 3); turns of empty text may be inserted
anywhere (I, 2). A row's first fault counts: blank (nothing but white space), duplicate (its role and text stand
earlier in the conversation), truncated (its last character besides white space is none of ``.!?``). Blank rows
and duplicates have to be deleted; a truncated row that stays costs 1 more.

The edits are a shortest path through (row, state), the state being the role that was written last. Backward
vectors of what is left to pay in each state are stored at every ``sqrt(n)``-th row only; walking forward, the
vectors of one block at a time are computed again from its checkpoint, and the path takes the least letter that
still costs the optimum. So the audit is the ASCII-least of the cheapest ones, as a letter leads to one state.

Rows meet by conversation twice: first as short records without their text, sorted by Spark, to find faults and
edits (a worker holds one byte a row of one conversation, and its audit); then the texts pass by in the same
order behind their conversation's audit, row by row. No conversation's texts are gathered, so one that holds a
third of all rows costs its task time but no memory.

Defined cases: null roles and texts are one space; null turns come first; rows of one turn are ordered by role
and then by the SHA-256 of their text, repeated rows stay; an empty role, or one of another initial than s, u or
a, can't be kept; rows without a conversation id are one conversation; further columns are ignored; an empty
table gives an empty table.
"""

from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakerisk.llm.common import ASCII_SPACE, ready

KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
ROLES = ("user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # the state that a written user or assistant leads to
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
INITIALS = "sua"
SOUND, DROPPED, TRUNCATED = range(3)  # what a row's fault asks for
NEVER = 1 << 60

AUDIT_SCHEMA = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
TURN_SCHEMA = "conv_id long, place long, role string, text string"
ROWS_PER_BATCH = 1000


def with_inserts(left: tuple[int, ...]) -> tuple[int, ...]:
    for _ in range(2):  # more than two insertions in a row never pay
        left = tuple(min(left[s], INSERT + left[NEXT[s]]) for s in range(4))
    return left


END = with_inserts((0, NEVER, NEVER, 0))


def code(initial: str, fault: int) -> int:
    """What the path has to know of a row, in one byte."""
    return (INITIALS.find(initial) + 1 if initial else 0) * 3 + fault


@lru_cache(maxsize=None)
def _stays(row: int) -> tuple[dict[int, int], bool, int]:
    """Where keeping leads from each state, whether the row may stay, and what staying costs."""
    initial, fault = divmod(row, 3)
    return (KEPT[INITIALS[initial - 1]] if initial else {}), fault != DROPPED, CUT if fault == TRUNCATED else 0


@lru_cache(maxsize=100_000)  # vectors less their minimum take few values
def _before(row: int, left: tuple[int, ...]) -> tuple[int, ...]:
    kept, may_stay, extra = _stays(row)
    out = []
    for state in range(4):
        best = DELETE + left[state]
        if may_stay:
            best = min(best, REROLE + extra + left[NEXT[state]], KEEP + extra + left[kept[state]] if state in kept else NEVER)
        out.append(best)
    return with_inserts(tuple(out))


def before(row: int, left: tuple[int, ...]) -> tuple[int, ...]:
    """The vector of what is left to pay before a row, from the one behind it."""
    base = min(left)
    return tuple(base + x for x in _before(row, tuple(x - base for x in left)))


def cheapest(rows: bytes) -> tuple[int, str]:
    """Cost and audit of the rows' codes."""
    n, step = len(rows), isqrt(len(rows)) + 1
    checkpoints, left = {}, END
    for i in range(n - 1, -1, -1):
        left = before(rows[i], left)
        if i % step == 0:
            checkpoints[i] = left
    cost, state, letters = left[START] if n else 0, START, bytearray()
    for first in range(0, n, step):
        last = min(first + step, n)
        block = [checkpoints.get(last, END)]
        for i in range(last - 1, first - 1, -1):
            block.append(before(rows[i], block[-1]))
        block.reverse()
        for row, now, then in zip(rows[first:last], block, block[1:]):
            kept, may_stay, extra = _stays(row)
            while now[state] != DELETE + then[state] and now[state] == INSERT + now[NEXT[state]]:
                letters += b"I"
                state = NEXT[state]
            if now[state] == DELETE + then[state]:
                letters += b"D"
            elif may_stay and state in kept and now[state] == KEEP + extra + then[kept[state]]:
                letters += b"K"
                state = kept[state]
            else:
                letters += b"R"
                state = NEXT[state]
    while n and END[state]:
        letters += b"I"
        state = NEXT[state]
    return cost, letters.decode()


class _Conversation:
    """What is known of a conversation while its rows pass by."""

    def __init__(self, key):
        self.key, self.codes, self.faults = key, bytearray(), [0, 0, 0]
        self.illegal, self.turns, self.first, self.last, self.before = 0, 0, None, None, None

    def add(self, turn, initial, blank, repeated, cut):
        fault = 0 if blank else 1 if repeated else 2 if cut else None
        if fault is not None:
            self.faults[fault] += 1
        self.codes.append(code(initial, SOUND if fault is None else TRUNCATED if fault == 2 else DROPPED))
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        if turn is not None and turn != self.last:
            self.turns, self.last = self.turns + 1, turn
            self.first = turn if self.first is None else self.first

    def row(self):
        gaps = min(self.last - self.first + 1 - self.turns, 2**63 - 1) if self.turns else 0
        return (self.key, gaps, *self.faults, self.illegal, *cheapest(bytes(self.codes)))


def _records(batches, names) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in names))


def _batches(rows: Iterator[tuple], names, types) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, ROWS_PER_BATCH)):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)], names=names)


def _audited(records):
    now = None
    for key, *row in records:
        if now is None or key != now.key:
            if now is not None:
                yield now.row()
            now = _Conversation(key)
        now.add(*row)
    if now is not None:
        yield now.row()


def _audits(batches):
    records = _records(batches, ["conv_id", "turn", "initial", "blank", "repeated", "cut"])
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    yield from _batches(_audited(records), names, [pa.int64()] * 7 + [pa.string()])


def _written(records):
    """``conv_id, place, role, text`` of the repaired turns, from rows in order behind their audit."""
    key, audit, at, state, place = None, "", 0, START, 0

    def inserted():
        nonlocal at, state, place
        while audit[at:at + 1] == "I":
            at, state, place = at + 1, NEXT[state], place + 1
            yield key, place - 1, ROLES[state - USER], ""

    for conv, kind, role, text in records:
        if kind == 0:
            yield from inserted()
            key, audit, at, state, place = conv, text, 0, START, 0
            continue
        yield from inserted()
        letter, at = audit[at], at + 1
        if letter == "D":
            continue
        if letter == "K":
            state = KEPT[role[0]][state]
        else:
            state = NEXT[state]
            role = ROLES[state - USER]
        place += 1
        yield key, place - 1, role, text
    yield from inserted()


def _turns(batches):
    written = _written(_records(batches, ["conv_id", "kind", "role", "text"]))
    yield from _batches(written, ["conv_id", "place", "role", "text"], [pa.int64(), pa.int64(), pa.string(), pa.string()])


def _plain(rows: DataFrame) -> DataFrame:
    """The rows with nulls replaced, and the digest that orders and compares texts."""
    ready(rows.sparkSession)
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.sha2(text, 256).alias("digest"), text.alias("text"),
    )


def audit(rows: DataFrame) -> DataFrame:
    """Per conversation of ``conv_id, turn, role, text``: faults, cost and audit of the cheapest edits."""
    last = F.substring(F.rtrim("text", F.lit(ASCII_SPACE)), -1, 1)
    short = _plain(rows).select(
        "conv_id", "turn", "role", "digest", (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))
    # one shuffle: rows of one role and text lie within their conversation's partition
    same = Window.partitionBy("conv_id", "role", "digest").orderBy("turn")
    seen = short.repartition("conv_id").withColumn("repeated", F.row_number().over(same) > 1)
    ordered = seen.sortWithinPartitions("conv_id", "turn", "role", "digest")
    return ordered.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "blank", "repeated", "cut").mapInArrow(_audits, AUDIT_SCHEMA)


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """The repaired turns ``conv_id, place, role, text``, each conversation in order within one partition."""
    heads = audits.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("digest"), F.col("audit").alias("text"))
    behind = _plain(rows).withColumn("kind", F.lit(1)).select(*heads.columns)
    ordered = heads.unionByName(behind).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    return ordered.select("conv_id", "kind", "role", "text").mapInArrow(_turns, TURN_SCHEMA)
