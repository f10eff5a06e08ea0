"""Incremental results equal full recomputation."""

import glob

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from lakerisk.functions.derive import add_raw_date_parts
from lakerisk.operators import risk
from lakerisk.plans import incremental as inc
from lakerisk.plans.lake import LakePaths


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    left, right = a.select(columns), b.select(columns)
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def full(silver):
    return inc.gold_from_base(risk.additive_base(silver), ["data", "segment"])


def test_late_rows_and_a_repeated_batch(spark, lake, scratch):
    paths = LakePaths(scratch("lake"))
    late = F.col("transaction_id") % 7 == 0
    inc.incremental_gold(paths, lake.silver.filter(~late), "a")
    inc.incremental_gold(paths, lake.silver.filter(late), "b")
    inc.incremental_gold(paths, lake.silver.filter(late), "b")
    same(inc.gold_from_base(inc.read_base(spark, paths), ["data", "segment"]), full(lake.silver))


def test_empty_batch_changes_nothing(spark, lake, scratch):
    paths = LakePaths(scratch("lake"))
    inc.incremental_gold(paths, lake.silver.limit(0), "none")
    inc.incremental_gold(paths, lake.silver, "all")
    inc.incremental_gold(paths, lake.silver.limit(0), "none")
    same(inc.gold_from_base(inc.read_base(spark, paths), ["data", "segment"]), full(lake.silver))


def test_untouched_days_are_not_rewritten(spark, lake, scratch):
    paths = LakePaths(scratch("lake"))
    inc.incremental_gold(paths, lake.silver, "all")
    base = inc.silver_and_base(paths)[1]
    before = set(glob.glob(base + "/data=*/*.parquet"))
    inc.incremental_gold(paths, lake.silver.filter("day = 3"), "again")
    changed = before ^ set(glob.glob(base + "/data=*/*.parquet"))
    assert changed and all("data=2024-01-03" in name for name in changed)


def test_ingest_adds_only_new_rows(spark, lake, scratch):
    path = scratch("raw")
    inc.incremental_ingest(path, lake.raw.filter("transaction_id % 3 = 0"))
    inc.incremental_ingest(path, lake.raw)
    inc.incremental_ingest(path, lake.raw)
    stored = spark.read.parquet(path)
    same(stored, add_raw_date_parts(lake.raw))


def test_ingest_keeps_a_later_version_of_an_id(spark, lake, scratch):
    path = scratch("raw")
    one = lake.raw.filter("transaction_id = 10")
    inc.incremental_ingest(path, one)
    inc.incremental_ingest(path, one.withColumn("amount", F.col("amount") + 1))
    assert spark.read.parquet(path).count() == 2


def test_compaction_keeps_the_rows(spark, lake, scratch):
    path = scratch("small")
    lake.raw_parts.repartition(12).write.partitionBy("year", "month").parquet(path)
    before = spark.read.parquet(path).drop("x")
    expected = add_raw_date_parts(lake.raw)
    assert len(glob.glob(path + "/year=2024/month=1/*.parquet")) == 12
    assert before.count() == expected.count()
    assert inc.compact_partition(spark, path, 2024, 1) == 1
    assert len(glob.glob(path + "/year=2024/month=1/*.parquet")) == 1
    same(spark.read.parquet(path), expected)
    assert inc.compact_partition(spark, path, 1999, 1) == 0


def without_time(silver):
    """Silver with some rows that have no time, as Bronze lets them through."""
    lost = F.col("transaction_id") % 11 == 0
    when_lost = {c: F.when(~lost, F.col(c)) for c in ("ts", "year", "month", "day", "hour", "day_of_week")}
    return silver.withColumns(when_lost)


def test_rows_without_a_time_count(spark, lake, scratch):
    paths, silver = LakePaths(scratch("lake")), without_time(lake.silver)
    inc.incremental_gold(paths, silver.filter("transaction_id % 2 = 0"), "a")
    inc.incremental_gold(paths, silver.filter("transaction_id % 2 = 1"), "b")
    inc.incremental_gold(paths, silver.filter("ts IS NULL AND transaction_id % 2 = 0").limit(0), "c")
    same(inc.gold_from_base(inc.read_base(spark, paths), ["data", "segment"]), full(silver))


def test_a_corrected_batch_loses_its_old_days_and_months(spark, lake, scratch):
    paths = LakePaths(scratch("lake"))
    later = lake.silver.withColumn("month", F.when(F.col("day") > 10, 2).otherwise(F.col("month")))
    later = later.withColumn("ts", F.expr("if(day > 10, ts + INTERVAL 1 MONTH, ts)"))
    inc.incremental_gold(paths, later, "a")
    kept = later.filter("month = 1 AND day <> 3")
    inc.incremental_gold(paths, kept, "a")
    same(inc.gold_from_base(inc.read_base(spark, paths), ["data", "segment"]), full(kept))
    inc.incremental_gold(paths, kept.limit(0), "a")
    assert not glob.glob(inc.silver_and_base(paths)[0] + "/*/*/batch=a/*.parquet")


def test_a_repeated_delivery_without_times_adds_nothing(spark, lake, scratch):
    path = scratch("raw")
    raw = lake.raw.withColumn("timestamp", F.expr("if(transaction_id % 11 = 0, NULL, timestamp)"))
    for _ in range(3):
        inc.incremental_ingest(path, raw)
    same(spark.read.parquet(path), add_raw_date_parts(raw))


def test_a_compacted_lake_takes_further_batches(spark, lake, scratch):
    paths = LakePaths(scratch("lake"))
    inc.incremental_gold(paths, lake.silver.filter("transaction_id % 2 = 0"), "a")
    inc.compact_partition(spark, inc.silver_and_base(paths)[0], 2024, 1)
    inc.incremental_gold(paths, lake.silver.filter("transaction_id % 2 = 1"), "b")
    inc.incremental_gold(paths, lake.silver.filter("transaction_id % 2 = 1"), "b")
    same(inc.gold_from_base(inc.read_base(spark, paths), ["data", "segment"]), full(lake.silver))


def test_compaction_sorts_no_rows(spark, lake, scratch, monkeypatch):
    """A task that sorted a month's rows would hold them; a month without a time is compacted alike."""
    path = scratch("small")
    raw = add_raw_date_parts(lake.raw.withColumn("timestamp", F.expr("if(transaction_id % 5 = 0, NULL, timestamp)")))
    raw.repartition(6).write.partitionBy("year", "month").parquet(path)
    before = spark.read.parquet(path).localCheckpoint()
    by_columns = []
    write = DataFrameWriter.partitionBy
    monkeypatch.setattr(DataFrameWriter, "partitionBy", lambda self, *cols: by_columns.append(cols) or write(self, *cols))
    assert inc.compact_partition(spark, path, 2024, 1) == 1
    assert inc.compact_partition(spark, path, None, None) == 1
    assert not by_columns, "Spark sorts what it writes by columns"
    same(spark.read.parquet(path), before)
    assert not glob.glob(path + "/_compacted*")
