"""The same definitions on a stream of transactions.

The stream is a parameter: a file source in this repository, any source with the raw columns
elsewhere. ``run_available`` works off what is there and stops.
"""

import math
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from lakerisk.functions.derive import utc_instant, utc_wall_clock
from lakerisk.functions.measures import fraud_count, fraud_rate_pct, row_count
from lakerisk.operators.deploy import PROBABILITY, scored
from lakerisk.operators.layers import distinct_rows, project_transactions, silver_transactions
from lakerisk.operators.ml import assemble
from lakerisk.operators.rules import STRICT, Rules, apply_rules, broken_rules
from lakerisk.plans.incremental import incremental_gold, stored_table
from lakerisk.plans.lake import LakePaths
from lakerisk.schemas import BRONZE_COLUMNS, BRONZE_SCHEMA, RAW_COLUMNS, TX_SCHEMA
from lakerisk.session import shared_dir
from lakerisk.sources.files import replace_partitions
from lakerisk.sources.versions import VersionedTable, unseen

EVENT_TIME = "event_time"
ARRIVED = "arrived"  # when the source's file was there; kept if the source has it
LATENCY_STEP = 0.01
ARRIVALS_SCHEMA = "year int, month int, latency_class long, rows long, rejected long, newest timestamp_ntz, batch string"
REJECT_SCHEMA = StructType([*TX_SCHEMA.fields, StructField("reasons", ArrayType(StringType()))])


def stream_bronze(
    raw: DataFrame, rules: Rules = STRICT, lateness: str = "1 hour", spread: int = 16
) -> DataFrame:
    """Rules and deduplication by id within the watermark. Rows behind it are lost; ``land`` loses none.

    Unlike the batch distinct, the first version of an id wins, as the state keeps ids and not rows.
    The watermark needs a zoned timestamp, so ``event_time`` holds ``ts`` read as UTC. A stream has
    no map-side distinct, so copies are first dropped per id and reading task, in ``spread`` groups: an id that makes up a
    third of the stream then reaches its one state task as ``spread`` rows. ``spread=1`` leaves that
    step out, for sources whose ids repeat little.
    """
    key = ["transaction_id"]
    timed = (
        project_transactions(apply_rules(raw, rules))
        .withColumn(EVENT_TIME, utc_instant("ts"))
        .withWatermark(EVENT_TIME, lateness)
    )
    if spread > 1:
        timed = (
            timed.withColumn("reader", F.spark_partition_id() % spread)
            .dropDuplicatesWithinWatermark(key + ["reader"]).drop("reader")
        )
    return timed.dropDuplicatesWithinWatermark(key)


def bronze_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, f"{path}/bronze", BRONZE_SCHEMA)


def rejects_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, f"{path}/rejects", REJECT_SCHEMA, "timestamp")


def land(
    raw: DataFrame, path: str, checkpoint: str, rules: Rules = STRICT,
    then: Callable[[DataFrame, str, int], None] | None = None,
) -> None:
    """Work off the available stream into stored Bronze under ``path``: the batch distinct, however late a row is.

    Equal rows share their time, so a micro-batch is compared with the stored files that touch its hours and with
    nothing else: what it reads follows its own rows, not the months they fall in. Rows that break a rule are stored
    beside Bronze with their reasons. ``then`` gets the new rows of a batch, the stream's id and the batch's number.
    A retried batch replaces itself. ``read_account`` tells what became of the raw rows. One stream writes to a path.
    """
    def body(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        name = f"{stream}-{number}"
        staged_path = shared_dir(spark, "landing")  # read several times below
        known = [c for c in (ARRIVED,) if c in batch.columns]
        marked = batch.select(*RAW_COLUMNS, *known).withColumn("reasons", broken_rules(rules))
        marked.write.parquet(staged_path)
        staged = spark.read.schema(marked.schema).parquet(staged_path)
        rows = distinct_rows(project_transactions(staged.filter("size(reasons) = 0")))
        bronze, rejects = bronze_table(spark, path), rejects_table(spark, path)
        seen = bronze.read(bronze.around(rows)).filter(F.col("batch") != name)
        bronze.replace(name, unseen(rows, seen, BRONZE_COLUMNS))
        rejects.replace(name, staged.filter("size(reasons) > 0").drop(*known))
        if known:
            replace_partitions(arrivals(staged).withColumn("batch", F.lit(name)), f"{path}/arrivals", ["batch"])
        new = bronze.read(bronze.files().where(F.array_contains("batches", name))).filter(F.col("batch") == name).select(*BRONZE_COLUMNS)
        counts = staged.agg(F.count("*").alias("raw"), F.count_if(F.size("reasons") > 0).alias("rejects"))
        account = counts.crossJoin(new.agg(F.count("*").alias("emitted")))
        replace_partitions(account.withColumn("batch", F.lit(name)), f"{path}/account", ["batch"])
        if then:
            then(new, stream, number)

    query = (
        raw.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return bronze_table(spark, path).read().select(*BRONZE_COLUMNS)


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """The rows that Bronze left out, as often as they came, with the list of their reasons."""
    return rejects_table(spark, path).read().select(*RAW_COLUMNS, "reasons")


def read_account(spark: SparkSession, path: str) -> DataFrame:
    """One row: ``raw = emitted + copies + rejects``. No row is dropped for being late."""
    stored = stored_table(spark, f"{path}/account", StructType.fromDDL("raw long, rejects long, emitted long, batch string"))
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("raw", "emitted", "rejects")]
    rows = spark.createDataFrame([], "raw long, emitted long, rejects long") if stored is None else stored
    return rows.agg(*sums).withColumn("copies", F.expr("raw - emitted - rejects"))


def arrivals(staged: DataFrame) -> DataFrame:
    """Additive counts of a delivery per month and latency class; a class is ``LATENCY_STEP`` wide, relative to its latency."""
    seconds = F.greatest(F.lit(0), F.unix_micros(F.col(ARRIVED)) - F.unix_micros(utc_instant("timestamp"))) / 1e6
    latency = F.when(seconds.isNotNull(), F.floor(F.log(seconds + 1) / math.log(1 + LATENCY_STEP)))
    return staged.groupBy(F.year("timestamp").alias("year"), F.month("timestamp").alias("month"), latency.alias("latency_class")).agg(
        row_count().alias("rows"), F.count_if(F.size("reasons") > 0).alias("rejected"), F.max("timestamp").alias("newest"))


def partition_latency(spark: SparkSession, path: str, quantiles: tuple[float, ...] = (0.5, 0.95, 0.99)) -> DataFrame:
    """Volume, rejected rows, newest record and quantiles of the seconds between event and arrival, per month.

    The quantiles are right to ``LATENCY_STEP`` and come from one row per latency class, some thousands a month.
    """
    stored = stored_table(spark, f"{path}/arrivals", ARRIVALS_SCHEMA)
    stored = spark.createDataFrame([], ARRIVALS_SCHEMA) if stored is None else stored
    month = ["year", "month"]
    classes = stored.groupBy(*month, "latency_class").agg(F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected"), F.max("newest").alias("newest"))
    timed = F.col("latency_class").isNotNull()
    below = Window.partitionBy(*month).orderBy(F.col("latency_class").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    placed = classes.withColumns({
        "upto": F.sum(F.when(timed, F.col("rows")).otherwise(0)).over(below),
        "timed": F.sum(F.when(timed, F.col("rows")).otherwise(0)).over(Window.partitionBy(*month))})
    seconds = F.pow(F.lit(1 + LATENCY_STEP), F.col("latency_class")) - 1
    named = {f"latency_p{round(100 * q)}": F.min(F.when(timed & (F.col("upto") >= q * F.col("timed")), seconds)) for q in quantiles}
    return placed.groupBy(*month).agg(
        F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected"), F.max("newest").alias("newest"),
        *[F.round(c, 3).alias(name) for name, c in named.items()], F.round(F.max(seconds), 3).alias("latency_max"))


def store_batches(path: str, made: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, str, int], None]:
    """A ``then`` of ``land`` that stores what is made of the new rows of each batch."""
    def store(new: DataFrame, stream: str, number: int) -> None:
        replace_partitions(made(new).withColumn("batch", F.lit(f"{stream}-{number}")), path, ["batch"])

    return store


def windows_table(spark: SparkSession, path: str, by: str = "segment") -> VersionedTable:
    return VersionedTable(spark, path, StructType.fromDDL(f"inicio timestamp_ntz, fim timestamp_ntz, {by} string, n long, f long"), "inicio")


def upsert_windows(
    path: str, silver_of: Callable[[DataFrame], DataFrame], length: str, slide: str | None = None, by: str = "segment",
) -> Callable[[DataFrame, str, int], None]:
    """A ``then`` of ``land`` that keeps one row per window and key, open and late windows too.

    The counts of the windows that the new rows touch are added to the stored rows, of the windows' months alone; the
    batch's number becomes part of the same version, so a retried batch counts once.
    """
    def upsert(new: DataFrame, stream: str, number: int) -> None:
        parts = window_parts(silver_of(new), length, slide, by)
        windows_table(new.sparkSession, path, by).merge(stream, number, parts, ["inicio", "fim", by], ["n", "f"])

    return upsert


def read_windows(spark: SparkSession, path: str, by: str = "segment") -> DataFrame:
    return windows_from_parts(windows_table(spark, path, by).read(), by)


def window_parts(silver: DataFrame, length: str, slide: str | None = None, by: str = "segment") -> DataFrame:
    """Additive counts of the windows that these rows touch, late ones included."""
    return (
        silver.withColumn(EVENT_TIME, utc_instant("ts"))
        .groupBy(F.window(EVENT_TIME, length, slide).alias("w"), by)
        .agg(row_count().alias("n"), fraud_count().alias("f"))
        .select(utc_wall_clock("w.start").alias("inicio"), utc_wall_clock("w.end").alias("fim"), by, "n", "f")
    )


def windows_from_parts(parts: DataFrame, by: str = "segment") -> DataFrame:
    """The windows by key as of the last batch, open ones too."""
    total, frauds = F.sum("n"), F.sum("f")
    return parts.groupBy("inicio", "fim", by).agg(
        total.alias("transacoes"), frauds.alias("fraudes"), fraud_rate_pct(frauds, total).alias("taxa_fraude_pct"))


def stream_silver(bronze: DataFrame, customers: DataFrame) -> DataFrame:
    """Enrichment with the static customer dimension."""
    return silver_transactions(bronze, customers)


def stream_risk_windows(
    silver: DataFrame, length: str = "1 day", slide: str | None = None, by: str = "segment"
) -> DataFrame:
    """Fraud count and rate per event-time window, tumbling or (with ``slide``) sliding."""
    window = F.window(EVENT_TIME, length, slide) if slide else F.window(EVENT_TIME, length)
    return (
        silver.groupBy(window.alias("w"), by)
        .agg(
            row_count().alias("transacoes"), fraud_count().alias("fraudes"),
            fraud_rate_pct(fraud_count(), row_count()).alias("taxa_fraude_pct"))
        .select(
            utc_wall_clock("w.start").alias("inicio"), utc_wall_clock("w.end").alias("fim"), by,
            "transacoes", "fraudes", "taxa_fraude_pct")
    )


def decision(score: Column, deny_at: float, review_at: float) -> Column:
    """A missing score is reviewed, never approved."""
    return F.when(score.isNull(), "review").otherwise(F.when(score >= deny_at, "deny").when(score >= review_at, "review").otherwise("approve"))


def stream_decision(
    silver: DataFrame, deny_at: float = 90.0, review_at: float = 60.0, score: str = "risk_score"
) -> DataFrame:
    """Approve, deny or send to review by a score column."""
    return silver.select(
        "transaction_id", "ts", F.col(score).alias("score"),
        decision(F.col(score), deny_at, review_at).alias("decisao"))


def stream_model_decision(
    indexed: DataFrame, model: PipelineModel, deny_at: float = 0.8, review_at: float = 0.5
) -> DataFrame:
    """The same by the fraud probability of a fitted model, over rows with indexed categories."""
    scored = model.transform(assemble(indexed)).withColumn(
        "probability_of_fraud", vector_to_array("probability")[1])
    return stream_decision(scored, deny_at, review_at, "probability_of_fraud")


def stream_deployed_decision(
    silver: DataFrame, model: PipelineModel, deny_at: float = 0.8, review_at: float = 0.5
) -> DataFrame:
    """The same by a deployed model, over Silver as it is: the indexer is part of the model."""
    return stream_decision(scored(silver, model), deny_at, review_at, PROBABILITY)


def run_available(
    stream: DataFrame, spark: SparkSession, name: str, output: str | None = None
) -> DataFrame:
    """Append everything available to Parquet and return the written rows."""
    output = output or shared_dir(spark, name)
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", shared_dir(spark, f"{name}-checkpoint"))
        .trigger(availableNow=True).start(output)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(output)


def gold_upsert(paths: LakePaths) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: each micro-batch of Silver refreshes the days it touches.

    Batches carry the id of the query, which lives in its checkpoint: a retried batch replaces itself,
    and another stream, or one with a new checkpoint, adds to the lake.
    """
    def upsert(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        incremental_gold(paths, batch.drop(EVENT_TIME), f"stream-{query}-{number}")

    return upsert


def stream_gold_upsert(silver: DataFrame, paths: LakePaths, checkpoint: str) -> None:
    """Work off the available Silver stream into the stored Gold base."""
    query = (
        silver.writeStream.foreachBatch(gold_upsert(paths))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
