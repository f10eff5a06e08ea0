"""Readers, writers and their layout."""

import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.operators import risk
from lakerisk.plans.lake import LakePaths, StoredLake, build_layers
from lakerisk.session import shared_dir
from lakerisk.sources import files
from tests.conftest import SF_SMALL
from tests.plans import plan

SCHEMA = T.StructType([
    T.StructField("id", T.IntegerType()), T.StructField("n", T.IntegerType()),
    T.StructField("t", T.TimestampNTZType()), T.StructField("flag", T.BooleanType())])
CLEAN = "id,n,t,flag\n1,2,2024-01-01 00:00:01.123456,True\n2,3,2024-01-01T00:00:00,false\n"
DIRTY = CLEAN + "3,x,2024-01-01 00:00:00,True\n4,5,not a date,True\n5,6\n"


def text(scratch, name, body):
    with open(scratch(name), "w") as out:
        out.write(body)
    return scratch(name)


def test_declared_types(spark, scratch):
    df = files.read_csv_strict(spark, text(scratch, "a.csv", CLEAN), SCHEMA)
    assert df.schema == SCHEMA
    assert [r["flag"] for r in df.orderBy("id").collect()] == [True, False]


@pytest.mark.parametrize("use", [lambda d: d.count(), lambda d: d.select("id").collect(), lambda d: d.collect()])
def test_a_bad_cell_anywhere_stops_the_read(spark, scratch, use):
    df = files.read_csv_strict(spark, text(scratch, "b.csv", DIRTY), SCHEMA)
    with pytest.raises(Exception, match="bad CSV row"):
        use(df)


def test_quarantine_splits_without_loss(spark, scratch):
    good, bad = files.read_csv_quarantine(spark, text(scratch, "c.csv", DIRTY), SCHEMA)
    assert (good.count(), bad.count()) == (2, 3)
    assert {r["id"] for r in good.select("id").collect()} == {1, 2}
    assert "3,x,2024-01-01 00:00:00,True" in [r[files.BAD_ROW] for r in bad.collect()]


def orders_as_raw(spark):
    """The orders table as transactions over many months."""
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    return orders.select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_totalprice").alias("amount"),
        (F.col("o_orderkey") % 20 == 0).alias("is_fraud"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("timestamp"))


def test_month_filter_prunes_partitions(spark, scratch):
    from lakerisk.functions.derive import add_raw_date_parts

    raw = add_raw_date_parts(orders_as_raw(spark))
    files.write_raw_partitioned(raw, scratch("m"))
    stored = spark.read.parquet(scratch("m"))
    assert stored.count() == raw.count()
    assert len(glob.glob(scratch("m") + "/year=*/month=*")) == raw.select("year", "month").distinct().count()
    first = raw.groupBy("year").agg(F.min("month").alias("m")).orderBy("year").first()
    df = risk.fraud_for_month(stored, files.month_range((first["year"], first["m"]), (first["year"], first["m"])))
    text_plan = plan(df)
    assert "PartitionFilters: [isnotnull(year" in text_plan
    assert "ReadSchema: struct<is_fraud:boolean>" in text_plan
    assert df.count() == 1


def test_month_range_over_year_ends(spark):
    df = spark.createDataFrame([(y, m) for y in range(2020, 2024) for m in range(1, 13)], "year int, month int")
    got = {tuple(r) for r in df.filter(files.month_range((2020, 11), (2022, 2))).collect()}
    assert got == {(2020, 11), (2020, 12), (2022, 1), (2022, 2)} | {(2021, m) for m in range(1, 13)}


def test_large_month_is_written_by_several_tasks(spark, scratch):
    from tests.plans import conf

    df = spark.range(400000).select(
        F.md5(F.col("id").cast("string")).alias("x"), F.lit(2024).alias("year"),
        F.when(F.col("id") < 10, 2).otherwise(1).alias("month"))
    with conf(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="2m"):
        files.write_raw_partitioned(df, scratch("big"))
    assert len(glob.glob(scratch("big") + "/year=2024/month=1/*.parquet")) > 1
    assert len(glob.glob(scratch("big") + "/year=2024/month=2/*.parquet")) == 1
    assert spark.read.parquet(scratch("big")).count() == 400000


def test_materialize_replaces(spark, scratch):
    files.materialize(spark.range(5).toDF("a"), "replaced_view", scratch("r"))
    again = files.materialize(spark.range(3).toDF("a"), "replaced_view", scratch("r"))
    assert again.count() == 3 and spark.table("replaced_view").count() == 3


@pytest.mark.parametrize("two_step", [False, True])
def test_catalog_table(spark, scratch, two_step):
    name = f"table_{int(two_step)}"
    stored = files.materialize(spark.range(4).toDF("a"), name, scratch(name), as_table=True, two_step=two_step)
    assert stored.count() == 4 and spark.catalog.tableExists(name)


def test_stored_layers_answer_like_the_lazy_ones(spark, lake, scratch):
    paths = LakePaths(scratch("lake"))
    stored = build_layers(lake, paths)
    assert isinstance(stored, StoredLake)
    for table in (risk.gold_fraud_risk, risk.analysis_segment, risk.kpi_global):
        assert sorted(map(str, table(stored.silver).collect())) == sorted(map(str, table(lake.silver).collect()))
    gold = files.read_layer(spark, paths.layer("gold", "gold_fraud_risk"))
    assert sorted(map(str, gold.collect())) == sorted(map(str, risk.gold_fraud_risk(lake.silver).collect()))
    assert glob.glob(scratch("lake") + "/gold/gold_daily_metrics/*.zstd.parquet")
    assert len(glob.glob(scratch("lake") + "/output/gold_daily_metrics/*.csv")) == 1


def test_stored_silver_scan_reads_only_the_columns_used(spark, lake, scratch):
    stored = build_layers(lake, LakePaths(scratch("lake2")))
    assert "ReadSchema: struct<channel:string,is_fraud:boolean>" in plan(risk.analysis_channel(stored.silver))


def test_scratch_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    assert folder is None or shared_dir(spark, "x").startswith(folder)
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
