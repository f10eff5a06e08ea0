"""CSV and Parquet readers and writers for the layers."""

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.schemas import CUSTOMER_SCHEMA, TX_SCHEMA

BAD_ROW = "_bad_row"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def _read_csv_marked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read with the declared schema; unparsable rows keep their text in ``BAD_ROW``."""
    marked = T.StructType(schema.fields + [T.StructField(BAD_ROW, T.StringType())])
    return (
        spark.read.schema(marked)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_ROW)
        .csv(path)
    )


def _never(schema: T.StructType) -> Column:
    """False for every bad row, though only known when read.

    Spark parses the selected columns of a CSV only, so a bad cell elsewhere goes unseen. The test
    therefore names every column: no row's cells equal its own whole line plus a line feed.
    """
    cells = F.concat_ws(",", *[F.col(c).cast("string") for c in schema.fieldNames()])
    return cells.eqNullSafe(F.concat(BAD_ROW, F.lit("\n")))


def read_csv_strict(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Fail on the first bad cell, also in a column the query later leaves out.

    Spark's own FAILFAST looks at the selected columns only.
    """
    bad = F.col(BAD_ROW)
    stop = F.raise_error(F.concat(F.lit("bad CSV row: "), bad)).cast("boolean")
    return (
        _read_csv_marked(spark, path, schema)
        .filter(F.when(bad.isNull(), True).when(_never(schema), True).otherwise(stop))
        .drop(BAD_ROW)
    )


def read_csv_quarantine(
    spark: SparkSession, path: str, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Split a CSV into rows that parse and rows that do not (with their text)."""
    rows = _read_csv_marked(spark, path, schema)
    good = F.when(F.col(BAD_ROW).isNull(), True).otherwise(_never(schema))
    return rows.filter(good).drop(BAD_ROW), rows.filter(~good)


def read_transactions_csv(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return _read_typed(spark, path, TX_SCHEMA, mode)


def read_customers_csv(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return _read_typed(spark, path, CUSTOMER_SCHEMA, mode)


def read_gold_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _read_typed(spark, path, schema, "FAILFAST")


def _read_typed(spark: SparkSession, path: str, schema: T.StructType, mode: str) -> DataFrame:
    if mode == "FAILFAST":
        return read_csv_strict(spark, path, schema)
    return spark.read.schema(schema).option("header", True).option("mode", mode).csv(path)


def write_layer(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write with a header. ``single_file`` is for frames of Gold size only."""
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode("overwrite").option("header", True).option("sep", ",")
        .option("timestampFormat", TIMESTAMP_FORMAT).option("timestampNTZFormat", TIMESTAMP_FORMAT)
        .csv(path)
    )


def write_raw_partitioned(raw_parts: DataFrame, path: str) -> None:
    """Replace the Raw copy laid out as ``year=/month=``.

    The rebalance groups each month's rows, and splits a large month over several tasks, so no
    month is a single task's work and none is scattered over every task's small files.
    """
    (
        raw_parts.hint("rebalance", "year", "month")
        .write.mode("overwrite").option("compression", "zstd")
        .partitionBy("year", "month").parquet(path)
    )


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Overwrite only the partitions that ``df`` holds rows for."""
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd").partitionBy(*by).parquet(path)
    )


def remove_partition(spark: SparkSession, path: str, values: dict[str, object]) -> None:
    """Remove one partition folder, if it is there; None stands for the partition of missing values."""
    folder, files = _partition_folder(spark, path, values)
    if files.exists(folder):
        files.delete(folder, True)


def replace_partition(spark: SparkSession, path: str, values: dict[str, object], by: str) -> None:
    """Put the folder ``by`` of the same file system, with all its files, in place of one partition folder."""
    folder, files = _partition_folder(spark, path, values)
    files.delete(folder, True)
    if not files.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(by), folder):
        raise RuntimeError(f"{folder} could not be replaced; its rows are in {by}")
    spark.catalog.refreshByPath(path)


def _partition_folder(spark: SparkSession, path: str, values: dict[str, object]):
    names = [f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in values.items()]
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([path, *names]))
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def month_range(first: tuple[int, int], last: tuple[int, int]) -> Column:
    """Partition predicate for the months ``first`` to ``last``, both included.

    A filter on the timestamp does not prune ``year=/month=`` folders; this one does.
    """
    year, month = F.col("year"), F.col("month")
    (y0, m0), (y1, m1) = first, last
    if y0 == y1:
        return (year == y0) & month.between(m0, m1)
    return (
        ((year == y0) & (month >= m0))
        | ((year > y0) & (year < y1))
        | ((year == y1) & (month <= m1))
    )


def dates_range(first: datetime.date, last: datetime.date, date: str) -> Column:
    """Rows of the days ``first`` to ``last``, with the month predicate that prunes the folders they lie in."""
    months = month_range((first.year, first.month), (last.year, last.month))
    return months & F.to_date(F.col(date)).between(F.lit(first), F.lit(last))


def in_calendar(partitioned: DataFrame, calendar: DataFrame) -> DataFrame:
    """Rows of the months that ``calendar`` (``year``, ``month``; at most one row a month) holds.

    The months are only known when the calendar is read: Spark then prunes the folders by its rows, as it broadcasts
    them anyway. A calendar is as small as the time it covers.
    """
    return partitioned.join(F.broadcast(calendar.select("year", "month").distinct()), ["year", "month"])


def materialize(
    df: DataFrame, name: str, path: str, as_table: bool = False, two_step: bool = False
) -> DataFrame:
    """Replace the stored table ``name`` by ``df`` and return the stored rows.

    ``as_table`` also registers it in the catalog; ``two_step`` creates it empty and inserts.
    """
    spark = df.sparkSession
    if not as_table:
        write_layer(df, path)
        stored = spark.read.parquet(path)
        stored.createOrReplaceTempView(name)
        return stored
    writer = lambda d: d.write.format("parquet").option("compression", "zstd")
    first = df.limit(0) if two_step else df
    writer(first).mode("overwrite").option("path", path).saveAsTable(name)
    if two_step:
        df.write.insertInto(name)
    return spark.table(name)
