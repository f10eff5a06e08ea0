"""Tables of versions: what readers see, batches, compaction, and what a batch has to read."""

import glob
import threading

import pytest
from pyspark.sql import functions as F

from lakerisk.operators import risk
from lakerisk.plans import incremental as inc
from lakerisk.plans.lake import LakePaths
from lakerisk.sources import versions
from lakerisk.sources.versions import ConcurrentCommit, VersionedTable
from lakerisk.streaming import stream
from tests.test_incremental import same
from tests.test_layers import tx
from tests.test_streaming import at, deliver, raw_stream


def days(spark, first, last, a_day=20, start="2024-01-01"):
    """Rows ``id, ts`` of the given days."""
    rows = spark.range(first * a_day, last * a_day)
    return rows.withColumn("ts", F.expr(f"TIMESTAMP_NTZ'{start}' + make_dt_interval(int(id / {a_day}), int(id % {a_day}), 0, 0)"))


def table(spark, path):
    return VersionedTable(spark, path, days(spark, 0, 1).schema)


def test_many_batches_become_few_files_and_readers_see_one_version(spark, scratch):
    t = table(spark, scratch("t"))
    for number in range(12):
        t.replace(f"b{number}", days(spark, 3 * number, 3 * number + 3))
    before = t.read()  # resolved before the compaction
    listed = t.files().count()
    for year, month in inc.months_of(t.files()):
        assert inc.compact_partition(spark, scratch("t"), year, month) == 1
    assert t.files().count() == 2 < listed  # January and February
    want = days(spark, 0, 36)
    same(before.select("id", "ts"), want)
    same(t.read().select("id", "ts"), want)
    assert {r["batch"] for r in t.read().select("batch").distinct().collect()} == {f"b{n}" for n in range(12)}
    assert inc.compact_partition(spark, scratch("t"), 2024, 1) == 1 and inc.compact_partition(spark, scratch("t"), 1999, 1) == 0


def test_an_old_batch_replaces_itself_after_compaction(spark, scratch):
    t = table(spark, scratch("t"))
    for number in range(4):
        t.replace(f"b{number}", days(spark, number, number + 1))
    t.compact(2024, 1)
    t.replace("b1", days(spark, 1, 2).where("id % 2 = 0").withColumn("id", -F.col("id")))
    t.replace("b2", days(spark, 2, 3).limit(0))
    got = {r["id"] for r in t.read().collect()}
    assert got == set(range(20)) | {-i for i in range(20, 40, 2)} | set(range(60, 80))
    newest = t.version()
    assert t.forget_before(newest) > 0 and {r["id"] for r in t.read().collect()} == got
    assert len(glob.glob(scratch("t") + "/versions/*.json")) == 1
    assert VersionedTable.open(spark, scratch("t")).read().count() == len(got)


def test_a_reader_during_compaction_sees_one_version(spark, scratch):
    t = table(spark, scratch("t"))
    for number in range(6):
        t.replace(f"b{number}", days(spark, number, number + 1))
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(table(spark, scratch("t")).read().count())

    reader = threading.Thread(target=read)
    reader.start()
    for number in range(3):
        t.compact(2024, 1)
        t.replace(f"c{number}", days(spark, 6, 6))
    stop.set()
    reader.join()
    assert seen and set(seen) == {120}


def test_a_second_writer_fails_and_changes_nothing(spark, scratch):
    t = table(spark, scratch("t"))
    t.replace("a", days(spark, 0, 1))
    marker = t._marker(t.version())
    t.replace("b", days(spark, 1, 2))
    with pytest.raises(ConcurrentCommit):
        t._commit(1, marker)
    assert t.version() == 2 and t.read().count() == 40


def test_rows_without_a_time_and_an_empty_table(spark, scratch):
    t = table(spark, scratch("t"))
    assert t.version() == 0 and t.read().count() == 0 and VersionedTable.open(spark, scratch("t")) is None
    t.replace("none", days(spark, 0, 0))
    assert t.read().count() == 0
    timeless = days(spark, 0, 1).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    t.replace("a", timeless)
    t.replace("b", days(spark, 0, 1))
    assert t.files([(None, None)]).count() == t.around(timeless).count() >= 1
    assert t.compact(None, None) == 1 and t.read().where("ts IS NULL").count() == 20


def test_bytes_read_follow_the_batch_and_not_the_month(spark, scratch):
    """A day's micro-batch meets the files of its hours, however many days of the month are stored."""
    path = scratch("out")
    read = []
    for day in range(1, 9):
        rows = [at(day, h, transaction_id=100 * day + h) for h in range(24)]
        deliver(tx(spark, *rows), scratch("in"))
    stream.land(raw_stream(spark, scratch("in")), path, scratch("checkpoint"))
    bronze = stream.bronze_table(spark, path)
    for day in (2, 8):
        rows = tx(spark, at(day, 3), at(day, 20, transaction_id=5)).withColumnRenamed("timestamp", "ts")
        read.append(bronze.around(rows).agg(F.sum("bytes")).first()[0])
    whole = bronze.files().agg(F.sum("bytes")).first()[0]
    assert max(read) < 1.3 * min(read) and 6 * max(read) < whole
    late = tx(spark, at(1, 3), at(8, 3, transaction_id=5)).withColumnRenamed("timestamp", "ts")
    assert {r["low"].day for r in bronze.around(late).collect()} == {1, 8}


def test_a_retried_batch_of_windows_counts_once(spark, lake, scratch):
    upsert = stream.upsert_windows(scratch("w"), lambda new: new, "1 day")
    parts = [lake.silver.where(f"transaction_id % 3 = {n}") for n in range(3)]
    for number, part in enumerate(parts):
        upsert(part, "s", number)
        upsert(part, "s", number)
    upsert(parts[0], "s", 0)
    got = stream.read_windows(spark, scratch("w"))
    same(got, stream.windows_from_parts(stream.window_parts(lake.silver, "1 day")))
    assert got.count() == stream.windows_table(spark, scratch("w")).read().count()  # one stored row a window
    assert stream.windows_table(spark, scratch("w")).applied("s") == 2


def test_windows_of_a_shuffled_backlog_are_all_there(spark, lake, scratch):
    raw = lake.raw.withColumn("part", F.pmod(F.xxhash64("transaction_id"), F.lit(3)))
    for part in range(3):
        deliver(raw.filter(f"part = {part}").drop("part"), scratch("in"))
    deliver(lake.raw.limit(50), scratch("in"))
    silver_of = lambda new: stream.stream_silver(new, lake.customers)
    stream.land(raw_stream(spark, scratch("in")), scratch("out"), scratch("checkpoint"),
                then=stream.upsert_windows(scratch("w"), silver_of, "12 hours", "6 hours"))
    same(stream.read_windows(spark, scratch("w")), stream.windows_from_parts(stream.window_parts(lake.silver, "12 hours", "6 hours")))
    rejects = stream.read_rejects(spark, scratch("out"))
    account = stream.read_account(spark, scratch("out")).first()
    again = lake.raw.unionByName(lake.raw.limit(50))
    assert account["rejects"] == rejects.count()
    assert account["raw"] == again.count() == account["emitted"] + account["copies"] + rejects.count()


def test_gold_from_the_base_and_customers_by_bits_and_sketches(spark, lake, scratch):
    paths = LakePaths(scratch("lake"))
    odd = F.col("transaction_id") % 2 == 1
    silver = lake.silver.withColumn("customer_id", F.when(F.col("customer_id") % 5 == 0, -F.col("customer_id")).otherwise(F.col("customer_id") * 100_003))
    for name, part in (("a", silver.where(odd)), ("b", silver.where(~odd)), ("a", silver.where(odd))):
        inc.incremental_gold(paths, part, name)
    base = inc.read_base(spark, paths)
    for name, table_of in risk.GOLD_FROM_BASE.items():
        same(table_of(base), getattr(risk, name)(silver))
    same(risk.segment_from_base(inc.read_customer_base(spark, paths)), risk.analysis_segment(silver))
    exact = {r["segment"]: r["clientes"] for r in risk.analysis_segment(silver).collect()}
    for row in risk.customers_from_sketches(risk.customer_sketches(silver), ["segment"]).collect():
        assert abs(row["clientes"] - exact[row["segment"]]) <= 0.05 * exact[row["segment"]]


def test_empty_events_give_empty_results(spark, lake, scratch):
    deliver(tx(spark, at(1, 1)).limit(0), scratch("in"))
    stream.land(raw_stream(spark, scratch("in")), scratch("out"), scratch("checkpoint"),
                then=stream.upsert_windows(scratch("w"), lambda new: stream.stream_silver(new, lake.customers), "1 day"))
    assert stream.read_bronze(spark, scratch("out")).count() == 0 and stream.read_rejects(spark, scratch("out")).count() == 0
    assert stream.read_windows(spark, scratch("w")).count() == 0
    assert stream.read_account(spark, scratch("out")).first().asDict() == {"raw": 0, "emitted": 0, "rejects": 0, "copies": 0}
    paths = LakePaths(scratch("lake"))
    assert inc.read_base(spark, paths).count() == 0
    inc.incremental_gold(paths, lake.silver.limit(0), "none")
    assert inc.read_base(spark, paths).count() == 0 and inc.read_customer_base(spark, paths).count() == 0


def test_a_large_month_is_sorted_in_pieces_and_its_files_stay_in_order(spark, scratch, monkeypatch):
    """No task sorts more than a piece, yet the files are as few as asked for and ordered by time; copies of a time too."""
    monkeypatch.setattr(versions, "PIECE_ROWS", 50)
    t = table(spark, scratch("t"))
    timeless = days(spark, 0, 10).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    for number in range(4):
        t.replace(f"b{number}", days(spark, 7 * number, 7 * number + 7))
        t.replace(f"n{number}", timeless)
    want = t.read().select("id", "ts", "batch")
    sorted_rows = []
    merged = VersionedTable._merged
    monkeypatch.setattr(VersionedTable, "_merged", lambda self, rows, month, files, pieces: sorted_rows.append((month, files, pieces)) or merged(self, rows, month, files, pieces))
    assert t.compact(2024, 1) == 1 and t.compact(None, None) == 1
    assert sorted_rows == [((2024, 1), 1, 12), ((None, None), 1, 16)]
    same(t.read().select("id", "ts", "batch"), want)
    row = t.files([(2024, 1)]).first()
    assert row["rows"] == 560 and row["batches"] == ["b0", "b1", "b2", "b3"]
    times = [r["ts"] for r in spark.read.parquet(row["file"]).select("ts").collect()]
    assert times == sorted(times)
    t.replace("b1", days(spark, 7, 8))
    assert t.read().count() == 560 - 140 + 20 + 800
