"""Incremental maintenance: land new rows, refresh touched days of Gold, Gold tables from the stored base, compaction."""

import math
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakerisk.functions.derive import add_raw_date_parts
from lakerisk.functions.measures import fraud_rate_pct
from lakerisk.operators.risk import BASE_SCHEMA, CUSTOMER_BASE_SCHEMA, additive_base, additive_measures, customer_base
from lakerisk.plans.paths import LakePaths
from lakerisk.schemas import RAW_COLUMNS
from lakerisk.session import shared_dir
from lakerisk.sources.files import remove_partition, replace_partition, replace_partitions
from lakerisk.sources.versions import VersionedTable, months_of, unseen

MONTH = ["year", "month"]


def stored_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame | None:
    """The stored rows, or None before anything was stored."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def in_months(df: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """Rows of the listed partitions, by a predicate the scan can prune with; a month may be missing."""
    wanted = F.lit(False)
    for year, month in months:
        wanted = wanted | (
            F.col("year").eqNullSafe(F.lit(year).cast("int")) & F.col("month").eqNullSafe(F.lit(month).cast("int")))
    return df.filter(wanted)


def in_span(column: str, rows: DataFrame) -> Column:
    """Rows within the time span of ``rows``, or without a time: a filter that prunes row groups."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    if low is None:
        return F.col(column).isNull()
    return F.col(column).isNull() | F.col(column).between(F.lit(low), F.lit(high))


def incremental_ingest(path: str, new_raw: DataFrame) -> None:
    """Append to partitioned Raw the rows of ``new_raw`` that are not there yet, each of them once.

    A row is new when no stored row equals it in every column, so a later, different version of an
    id is kept and a repeated delivery adds nothing. Equal rows share their time: only the row groups of
    the touched months that lie in the delivery's time span are read back, and rows are compared where id and hash
    agree. Rows are written in the order of their time, so that a delivery of a day meets that day alone.
    """
    spark = new_raw.sparkSession
    # Written once, so that the months, the comparison and the append read the same delivery.
    staged_path = shared_dir(spark, "delivery")
    parted = add_raw_date_parts(new_raw)
    parted.write.parquet(staged_path)
    staged = spark.read.schema(parted.schema).parquet(staged_path)
    stored, fresh = stored_table(spark, path, staged.schema), staged
    if stored is not None:
        touched = in_months(stored, months_of(staged)).filter(in_span("timestamp", staged))
        fresh = unseen(staged, touched, RAW_COLUMNS)
    (
        fresh.hint("rebalance", *MONTH).sortWithinPartitions(*MONTH, "timestamp")
        .write.mode("append").option("compression", "zstd").partitionBy(*MONTH).parquet(path)
    )


def silver_table(spark: SparkSession, paths: LakePaths, schema: StructType | None = None) -> VersionedTable | None:
    path = silver_and_base(paths)[0]
    return VersionedTable.open(spark, path) or (schema and VersionedTable(spark, path, schema))


def incremental_gold(paths: LakePaths, new_silver: DataFrame, batch: str) -> None:
    """Store a batch of Silver rows and refresh the additive Gold base for the days it touches.

    A batch stored again replaces its old version, months included that the new version lacks. The days
    of both versions are recomputed from the stored Silver files that hold them, late rows and rows without a
    time included, and replace the old ones. The days are noted in the lake before anything is replaced
    and forgotten at the end, so a call repeated after a failure ends in the same tables.
    """
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"a batch name is a folder name: {batch!r}")
    spark = new_silver.sparkSession
    base_path, people_path = silver_and_base(paths)[1], customers_path(paths)
    staged_path = shared_dir(spark, "batch")
    new_silver.write.parquet(staged_path)
    staged = spark.read.schema(new_silver.schema).parquet(staged_path)
    silver = silver_table(spark, paths, new_silver.schema)

    days = lambda rows: rows.select(F.to_date("ts").alias("touched")).distinct()
    before = silver.files().where(F.array_contains("batches", batch))
    touched = days(staged).unionByName(days(silver.read(before).where(F.col("batch") == batch)))
    noted_path = paths.layer("gold", f"touched_days/{batch}")
    touched.coalesce(1).write.mode("append").parquet(noted_path)  # one row per day of the batch
    noted = spark.read.schema(touched.schema).parquet(noted_path).distinct()

    silver.replace(batch, staged)
    all_days = {row["touched"] for row in noted.collect()}
    if all_days:
        current = silver.read(silver.around(noted.withColumnRenamed("touched", "ts"), "day")).withColumn("data", F.to_date("ts"))
        current = current.join(F.broadcast(noted), F.col("data").eqNullSafe(F.col("touched")), "left_semi")
        replace_partitions(additive_base(current), base_path, ["data"])
        replace_partitions(customer_base(current), people_path, ["data"])
        all_days -= {row["data"] for row in current.select("data").distinct().collect()}
    for day in all_days:
        remove_partition(spark, base_path, {"data": day})
        remove_partition(spark, people_path, {"data": day})
    remove_partition(spark, noted_path, {})


def silver_and_base(paths: LakePaths) -> tuple[str, str]:
    return paths.layer("silver", "transactions_by_month"), paths.layer("gold", "additive_base")


def customers_path(paths: LakePaths) -> str:
    return paths.layer("gold", "customer_base")


def read_base(spark: SparkSession, paths: LakePaths) -> DataFrame:
    return read_by_day(spark, silver_and_base(paths)[1], BASE_SCHEMA)


def read_customer_base(spark: SparkSession, paths: LakePaths) -> DataFrame:
    return read_by_day(spark, customers_path(paths), CUSTOMER_BASE_SCHEMA)


def read_by_day(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A table stored by day; empty before anything was stored."""
    stored = stored_table(spark, path, schema)
    return spark.createDataFrame([], schema) if stored is None else stored


def gold_from_base(base: DataFrame, dims: list[str]) -> DataFrame:
    """A Gold table summed from the stored base; rates are derived here and never stored."""
    return base.groupBy(*dims).agg(*additive_measures())


def compact_partition(
    spark: SparkSession, path: str, year: int, month: int, target_mb: int = 256
) -> int:
    """Merge the files of one month into files of about ``target_mb``; returns their number afterwards.

    A table of versions gets a new version, whatever the number of batches its files came from; readers see the old
    one or the new one. A folder of ``year=/month=`` is replaced by a folder beside it that is complete before, so a
    failure at any point leaves a full copy behind. A file is written from the old ones one after the other: no task
    sorts or holds its rows.
    """
    versioned = VersionedTable.open(spark, path)
    if versioned is not None:
        return versioned.compact(year, month, target_mb)
    old = in_months(spark.read.parquet(path), [(year, month)])
    sizes = old.select("_metadata.file_path", "_metadata.file_size").distinct()
    found = sizes.agg(F.sum("file_size").alias("bytes"), F.count("*").alias("files")).first()
    if found["bytes"] is None:
        return 0
    files = max(1, math.ceil(found["bytes"] / (target_mb * 1024 * 1024)))
    if found["files"] <= files:
        return found["files"]
    merged_path = f"{path.rstrip('/')}/_compacted-{uuid.uuid4().hex}"  # no reader of the table looks into it
    old.drop(*MONTH).coalesce(files).write.option("compression", "zstd").parquet(merged_path)
    merged = spark.read.schema(old.drop(*MONTH).schema).parquet(merged_path)
    if merged.count() != old.count():
        raise RuntimeError(f"compaction of {year}-{month} lost rows; the month is unchanged")
    stored = merged.select("_metadata.file_path").distinct().count()
    replace_partition(spark, path, {"year": year, "month": month}, merged_path)
    return stored
