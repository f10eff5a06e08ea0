"""Every operator as a named query over the given tables."""

import datetime as dt
from collections.abc import Callable

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerisk.functions import derive, measures
from lakerisk.functions.measures import row_count
from lakerisk.operators import bucketed, deploy, feeds, layers, ml, ordering, quality, risk, rules
from lakerisk.plans import incremental, lake as lake_plans
from lakerisk.plans.lake import Lake, LakePaths
from lakerisk.schemas import (
    BRONZE_SCHEMA,
    CHANNEL_ORDER,
    GOLD_FRAUD_RISK_SCHEMA,
    TX_SCHEMA,
)
from lakerisk.session import shared_dir, prepare
from lakerisk.sources import files, tables
from lakerisk.streaming import stream

Query = Callable[[Lake], DataFrame]

AS_OF = "2024-02-01"
INCREMENT_FROM = "2024-01-20"
SWEEP = [10.0, 25.0, 50.0, 75.0, 90.0, 99.0, 120.0]


def as_of():
    return F.lit(AS_OF).cast("date")


def ml_inputs(lake: Lake) -> DataFrame:
    return ml.ml_input(lake.silver)


def ml_train(lake: Lake) -> DataFrame:
    return ml.stratified_split(ml_inputs(lake)).filter(~F.col("is_test"))


# Sources and sinks

def scan_tx_csv(lake: Lake) -> DataFrame:
    path = shared_dir(lake.spark, "tx-csv")
    files.write_csv(lake.raw, path)
    return files.read_transactions_csv(lake.spark, path)


def scan_customer_csv(lake: Lake) -> DataFrame:
    path = shared_dir(lake.spark, "customer-csv")
    files.write_csv(lake.raw_customers, path)
    return files.read_customers_csv(lake.spark, path)


def scan_csv_quarantine(lake: Lake) -> DataFrame:
    """Raw with some cells spoiled, split into rows that parse and rows that do not."""
    path = shared_dir(lake.spark, "dirty-csv")
    key = F.col("transaction_id")
    dirty = lake.raw.withColumns({
        "amount": F.when(key % 97 == 0, "x").otherwise(F.col("amount").cast("string")),
        "timestamp": F.when(key % 89 == 1, "not a date").otherwise(F.col("timestamp").cast("string")),
    })
    files.write_csv(dirty, path)
    good, bad = files.read_csv_quarantine(lake.spark, path, TX_SCHEMA)
    return (
        good.select("transaction_id", F.lit("good").alias("kind"))
        .unionByName(bad.select("transaction_id", F.lit("bad").alias("kind")))
    )


def scan_layer_parquet(lake: Lake) -> DataFrame:
    path = shared_dir(lake.spark, "silver")
    files.write_layer(lake.silver, path)
    return files.read_layer(lake.spark, path)


def scan_gold_csv(lake: Lake) -> DataFrame:
    path = shared_dir(lake.spark, "gold-csv")
    files.write_csv(risk.gold_fraud_risk(lake.silver), path, single_file=True)
    return files.read_gold_csv(lake.spark, path, GOLD_FRAUD_RISK_SCHEMA)


def sink_parquet_zstd(lake: Lake) -> DataFrame:
    path = shared_dir(lake.spark, "bronze")
    files.write_layer(lake.bronze, path)
    return files.read_layer(lake.spark, path)


def sink_csv(lake: Lake) -> DataFrame:
    table = risk.gold_channel_risk(lake.silver)
    path = shared_dir(lake.spark, "channel-csv")
    files.write_csv(table, path, single_file=True)
    return files.read_gold_csv(lake.spark, path, table.schema)


def stored_raw_parts(lake: Lake) -> DataFrame:
    path = shared_dir(lake.spark, "raw-by-month")
    files.write_raw_partitioned(lake.raw_parts, path)
    return lake.spark.read.parquet(path)


def scan_month_pruned(lake: Lake) -> DataFrame:
    return risk.fraud_for_month(stored_raw_parts(lake), files.month_range((2024, 1), (2024, 1)))


def stored_orders(lake: Lake) -> DataFrame:
    """The given orders by month: some eighty folders."""
    path = shared_dir(lake.spark, "orders-by-month")
    orders = lake.spark.read.parquet(f"{lake.folder}/orders.parquet")
    parts = orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    files.write_raw_partitioned(parts, path)
    return lake.spark.read.parquet(path)


def orders_of_quarter(orders: DataFrame, quarter: int) -> DataFrame:
    """Orders and money per month of one quarter of every year, chosen by a calendar that is itself derived."""
    calendar = orders.sparkSession.sql("SELECT explode(sequence(DATE'1990-01-01', DATE'2030-12-01', INTERVAL 1 MONTH)) AS day")
    months = calendar.filter(F.quarter("day") == quarter).select(F.year("day").alias("year"), F.month("day").alias("month"))
    return files.in_calendar(orders, months).groupBy("year", "month").agg(
        row_count().alias("orders"), measures.money_sum(F.col("o_totalprice")).alias("total"))


def scan_orders_days(lake: Lake) -> DataFrame:
    """Orders of a span of days, whose month folders alone are read."""
    days = files.dates_range(dt.date(1995, 11, 20), dt.date(1996, 2, 10), "o_orderdate")
    return stored_orders(lake).filter(days).groupBy("year", "month").agg(row_count().alias("orders"))


def table_replace(lake: Lake) -> DataFrame:
    """Store a table and rebuild it under the same name: the rows do not add up."""
    path = shared_dir(lake.spark, "replaced")
    files.materialize(lake.customers, "bronze_customers_view", path)
    return files.materialize(lake.customers, "bronze_customers_view", path)


def ctas_parquet(lake: Lake) -> DataFrame:
    path = shared_dir(lake.spark, "ctas")
    name = "lakerisk_" + path.rsplit("-", 1)[1]
    return files.materialize(
        risk.gold_fraud_risk(lake.silver), name, path, as_table=True, two_step=True)


def counted_layers(lake: Lake) -> DataFrame:
    """Rows of Raw, Bronze and Silver, counted while Silver is written: one pass for all three."""
    seen = quality.Counted()
    bronze = seen.through("bronze", layers.bronze_transactions(seen.through("raw", lake.raw)))
    silver = seen.through("silver", layers.silver_transactions(bronze, lake.customers))
    files.write_layer(silver, shared_dir(lake.spark, "counted-silver"))
    return quality.counts_table(lake.spark, {"raw": 0, "bronze": 0, "silver": 0} | seen.counts())


# Incremental maintenance

def split_on_day(df: DataFrame, ts: str) -> tuple[DataFrame, DataFrame]:
    early = F.col(ts) < F.lit(INCREMENT_FROM).cast("timestamp_ntz")
    return df.filter(early), df.filter(~early)


def new_paths(lake: Lake) -> LakePaths:
    return LakePaths(shared_dir(lake.spark, "lake"))


def stored_base(lake: Lake) -> LakePaths:
    """A lake that took Silver in two batches, the second one twice."""
    paths = new_paths(lake)
    for number, part in enumerate(split_on_day(lake.silver, "ts")):
        for _ in range(number + 1):
            incremental.incremental_gold(paths, part, f"batch-{number}")
    return paths


def incremental_gold(lake: Lake) -> DataFrame:
    return incremental.gold_from_base(incremental.read_base(lake.spark, stored_base(lake)), ["data", "segment"])


def gold_from_stored_base(name: str) -> Query:
    return lambda lake: risk.GOLD_FROM_BASE[name](incremental.read_base(lake.spark, stored_base(lake)))


def compact_batches(lake: Lake) -> DataFrame:
    """Silver stored in several batches and compacted, then one batch stored again."""
    spark, paths = lake.spark, new_paths(lake)
    silver = incremental.silver_table(spark, paths, lake.silver.schema)
    part = F.pmod(F.xxhash64("transaction_id"), F.lit(4))
    for number in range(4):
        silver.replace(f"batch-{number}", lake.silver.where(part == number))
    for year, month in incremental.months_of(silver.files()):
        silver.compact(year, month)
    silver.replace("batch-2", lake.silver.where(part == 2))
    return silver.read().select(*lake.silver.columns)


def incremental_ingest(lake: Lake) -> DataFrame:
    """A first delivery, then the whole of Raw: only the rows not landed yet are added."""
    path = shared_dir(lake.spark, "raw-landing")
    first, _ = split_on_day(lake.raw, "timestamp")
    incremental.incremental_ingest(path, first)
    incremental.incremental_ingest(path, lake.raw)
    return lake.spark.read.parquet(path)


def compact_partition(lake: Lake) -> DataFrame:
    path = shared_dir(lake.spark, "raw-small-files")
    (lake.raw_parts.repartition(16).write.partitionBy("year", "month").parquet(path))
    stored = lake.spark.read.parquet(path)
    for year, month in incremental.months_of(stored):
        incremental.compact_partition(lake.spark, path, year, month)
    return lake.spark.read.parquet(path)


# Exports

def exported_analysis(name: str) -> Query:
    """One analysis, read back from its exported CSV."""
    def run(lake: Lake) -> DataFrame:
        paths = new_paths(lake)
        table = lake_plans.export_analyses(lake, paths)[name]
        return files.read_gold_csv(lake.spark, paths.layer("output", name), table.schema)

    return run


def exported_model_facts(lake: Lake) -> DataFrame:
    """The rows of each exported model table."""
    paths, spark = new_paths(lake), lake.spark
    rows = [(name, files.read_gold_csv(spark, paths.layer("output", name), table.schema).count()) for name, table in lake_plans.export_models(lake, paths).items()]
    return spark.createDataFrame(rows, "tabela string, linhas long")


# Streams

def raw_stream(lake: Lake) -> DataFrame:
    """The given events as a stream of raw transactions."""
    events = tables.stream_events(lake.spark, lake.folder)
    return tables.transactions_from_events(events, tables.read_customer(lake.spark, lake.folder), (stream.ARRIVED,))


def partition_latency(lake: Lake) -> DataFrame:
    path = shared_dir(lake.spark, "stream-latency")
    stream.land(raw_stream(lake), path, f"{path}/checkpoint")
    return stream.partition_latency(lake.spark, path)


def latency_facts(lake: Lake) -> DataFrame:
    """The figures that SQL can count, and that the quantiles are in order."""
    rising = F.expr("0 < latency_p50 AND latency_p50 <= latency_p95 AND latency_p95 <= latency_p99 AND latency_p99 <= latency_max")
    return partition_latency(lake).select("year", "month", "rows", "rejected", "newest", rising.alias("rising"))


def stream_bronze(lake: Lake) -> DataFrame:
    path = shared_dir(lake.spark, "stream-bronze")
    stream.land(raw_stream(lake), path, shared_dir(lake.spark, "bronze-checkpoint"))
    return stream.read_bronze(lake.spark, path)


def stream_rejects(lake: Lake) -> DataFrame:
    path = shared_dir(lake.spark, "stream-rejects")
    stream.land(raw_stream(lake), path, f"{path}/checkpoint")
    return stream.read_rejects(lake.spark, path).select(
        "transaction_id", F.concat_ws(",", F.array_sort("reasons")).alias("reasons"))


def landed(lake: Lake, name: str, made: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What is made of Silver, batch by batch."""
    spark, path = lake.spark, shared_dir(lake.spark, name)
    of_silver = lambda new: made(stream.stream_silver(new, lake.customers))
    stream.land(
        raw_stream(lake), f"{path}/landed", f"{path}/checkpoint",
        then=stream.store_batches(f"{path}/made", of_silver))
    schema = of_silver(spark.createDataFrame([], BRONZE_SCHEMA)).schema
    stored = incremental.stored_table(spark, f"{path}/made", schema)
    return spark.createDataFrame([], schema) if stored is None else stored.select(*schema.fieldNames())


def stream_silver(lake: Lake) -> DataFrame:
    return landed(lake, "stream-silver", lambda silver: silver)


def stream_windows(lake: Lake, length: str, slide: str | None = None) -> DataFrame:
    """All windows, open ones too, as of the last batch."""
    path = shared_dir(lake.spark, "stream-windows")
    silver_of = lambda new: stream.stream_silver(new, lake.customers)
    stream.land(
        raw_stream(lake), f"{path}/landed", f"{path}/checkpoint",
        then=stream.upsert_windows(f"{path}/windows", silver_of, length, slide))
    return stream.read_windows(lake.spark, f"{path}/windows")


def stream_decision(lake: Lake) -> DataFrame:
    return landed(lake, "stream-decision", stream.stream_decision)


def stream_gold_upsert(lake: Lake) -> DataFrame:
    paths, path = new_paths(lake), shared_dir(lake.spark, "upsert")
    stream.land(
        raw_stream(lake), f"{path}/landed", f"{path}/checkpoint",
        then=lambda new, name, number: incremental.incremental_gold(
            paths, stream.stream_silver(new, lake.customers), f"stream-{name}-{number}"))
    return incremental.gold_from_base(incremental.read_base(lake.spark, paths), ["data", "segment"])


# Models

def test_scores(lake: Lake, kind: str) -> DataFrame:
    """The test rows' scores by one model."""
    inputs = ml.stored_inputs(lake.silver)
    model = deploy.fit(inputs, kind)
    return deploy.scored(inputs.filter("is_test"), model).select(
        "transaction_id", "label", F.col(deploy.PROBABILITY).alias("score"))


def batch_score(lake: Lake) -> DataFrame:
    inputs = ml.stored_inputs(lake.silver)
    rows = deploy.scored(inputs, deploy.fit(inputs, "logistic"))
    return ml.review_queue(rows.select("transaction_id", "label", F.col(deploy.PROBABILITY).alias("score")))


def fitted(lake: Lake, kind: str):
    return deploy.fit(ml.stored_inputs(lake.silver), kind)


def stream_model_decision(lake: Lake) -> DataFrame:
    """A model trained on Silver, stored, read back and applied to the stream."""
    folder = shared_dir(lake.spark, "models")
    deploy.save(fitted(lake, "logistic"), folder, 1)
    model = deploy.load(lake.spark, folder)
    return landed(lake, "stream-model", lambda silver: stream.stream_deployed_decision(silver, model))


# What holds exactly of models that SQL cannot fit

def score_facts(lake: Lake, kind: str) -> DataFrame:
    """Every test row once, its label, and that its score is a probability."""
    return test_scores(lake, kind).select("transaction_id", "label", F.col("score").between(0.0, 1.0).alias("probability"))


def threshold_facts(lake: Lake) -> DataFrame:
    rows = ml.predict(test_scores(lake, "logistic"))
    return rows.select("transaction_id", (F.col("predicted") == F.when(F.col("score") >= 0.5, 1).otherwise(0)).alias("by_threshold"))


def gradient_facts(lake: Lake) -> DataFrame:
    """At the optimum no coefficient can be improved."""
    inputs = ml.stored_inputs(lake.silver)
    slopes = deploy.gradient(inputs.filter(~F.col("is_test")), deploy.fit(inputs, "logistic"))
    return slopes.select("feature", (F.abs("gradient") < 1e-3).alias("at_optimum"))


def importance_facts(lake: Lake) -> DataFrame:
    found = ml.importances(lake.spark, fitted(lake, "forest"))
    return found.agg(row_count().alias("features"), F.round(F.sum("importance"), 9).alias("total"), (F.min("importance") >= 0).alias("none_negative"))


def metric_facts(lake: Lake) -> DataFrame:
    """The area of each model by our count equals that of Spark's evaluator."""
    _, _, scores = deploy.score_sides(lake.silver)
    out = []
    for kind, name in deploy.KINDS.items():
        evaluator = BinaryClassificationEvaluator(rawPredictionCol=kind, labelCol="label", numBins=0)
        ours = ml.roc_auc(scores, kind, "label").first()["auc"]
        out.append((name, abs(ours - evaluator.evaluate(scores)) < 1e-9))
    return lake.spark.createDataFrame(out, "modelo string, equal boolean")


def batch_score_facts(lake: Lake) -> DataFrame:
    """Every row of Silver is scored once, and a part of the rows gets the same scores as the whole."""
    inputs = ml.stored_inputs(lake.silver)
    model = deploy.fit(inputs, "logistic")
    score = lambda rows: deploy.scored(rows, model).select("transaction_id", deploy.PROBABILITY)
    part = score(inputs.filter("channel = 'web'")).withColumnRenamed(deploy.PROBABILITY, "alone").distinct()
    return (
        score(inputs).join(part, "transaction_id", "left").groupBy("transaction_id")
        .agg(row_count().alias("rows"), F.bool_and(F.coalesce(F.col("alone") == F.col(deploy.PROBABILITY), F.lit(True))).alias("same_alone")))


def feed_model_facts(lake: Lake) -> DataFrame:
    """The panel's confusion rows add up to the classes of the test rows."""
    panel = ml.feed_models(deploy.train_models(lake.silver))
    return panel.filter("tabela = 'confusion'").groupBy("item").agg(F.sum("valor").cast("long").alias("rows"))


def stream_model_facts(lake: Lake) -> DataFrame:
    """Every transaction is decided once, by the cuts of its score."""
    rows = stream_model_decision(lake)
    cut = stream.decision(F.col("score"), 0.8, 0.5) == F.col("decisao")
    return rows.select("transaction_id", "ts", cut.alias("by_cuts"))


def rule_prediction(lake: Lake) -> DataFrame:
    return ml.predict(lake.silver, "risk_score", 50.0)


QUERIES: dict[str, Query] = {
    # Sources and sinks
    "scan_tx_csv": scan_tx_csv,
    "scan_customer_csv": scan_customer_csv,
    "scan_csv_quarantine": scan_csv_quarantine,
    "scan_layer_parquet": scan_layer_parquet,
    "scan_silver_columns": lambda lake: ml.load_features(lake.silver),
    "scan_gold_csv": scan_gold_csv,
    "sink_parquet_zstd": sink_parquet_zstd,
    "sink_csv": sink_csv,
    "sink_partitioned": stored_raw_parts,
    "scan_month_pruned": scan_month_pruned,
    "scan_orders_quarter": lambda lake: orders_of_quarter(stored_orders(lake), 2),
    "scan_orders_days": scan_orders_days,
    "table_replace": table_replace,
    "ctas_parquet": ctas_parquet,
    "layer_counts": counted_layers,
    # Projections and derived columns
    "raw_date_parts": lambda lake: lake.raw_parts,
    "bronze_project": lambda lake: layers.project_transactions(lake.raw),
    "customer_project": lambda lake: layers.project_customers(lake.raw_customers),
    "normalize_bool": lambda lake: lake.raw.select(
        "transaction_id", F.initcap(F.col("is_fraud").cast("string")).alias("is_fraud_text")
    ).withColumn("is_fraud", derive.normalize_bool(F.col("is_fraud_text"))),
    "silver_date_parts": lambda lake: derive.add_date_parts(
        lake.bronze.select("transaction_id", "ts")),
    "date_parts_legacy": lambda lake: derive.add_iso_weekday(
        lake.bronze.select("transaction_id", "ts")),
    "time_period": lambda lake: lake.bronze.select(
        "transaction_id", F.hour("ts").alias("hour"),
        derive.time_period(F.hour("ts")).alias("time_period")),
    "amount_band": lambda lake: lake.bronze.select(
        "transaction_id", "amount", derive.amount_band(F.col("amount")).alias("amount_band")),
    "silver_star": lambda lake: layers.silver_star(lake.bronze, lake.customers),
    "cohort_label": lambda lake: lake.customers.select(
        "customer_id", "created_at",
        derive.cohort(F.col("created_at"), as_of()).alias("cohort")),
    "preview_columns": lambda lake: quality.preview(
        lake.silver, ["amount", "amount_band", "year", "month", "day", "day_of_week"]),
    # Filters
    "f_not_null_ids": lambda lake: lake.raw.filter(rules.NOT_NULL_IDS),
    "f_positive_amount": lambda lake: lake.raw.filter(rules.POSITIVE_AMOUNT),
    "f_risk_range": lambda lake: lake.raw.filter(rules.RISK_IN_RANGE),
    "f_credit_range": lambda lake: lake.raw.filter(rules.CREDIT_IN_RANGE),
    "f_status_in": lambda lake: lake.raw.filter(rules.KNOWN_STATUS),
    "f_segment_type": lambda lake: risk.purchases_of(lake.silver, "Premium", "compra"),
    "f_is_null": lambda lake: quality.missing(
        layers.left_diagnose(lake.bronze, lake.customers), "customer_segment"
    ).select("transaction_id", "customer_id", "customer_segment"),
    "bronze_rejects": lambda lake: rules.reject_counts(lake.raw),
    "bronze_reject_rows": lambda lake: rules.rejects(lake.raw).select(
        "transaction_id", F.concat_ws(",", F.array_sort("reasons")).alias("reasons")),
    # Layers
    "bronze_transactions": lambda lake: lake.bronze,
    "bronze_tx_lab": lambda lake: lake.bronze_lab,
    "bronze_customers": lambda lake: lake.customers,
    "silver_transactions": lambda lake: lake.silver,
    "silver_bucketed": lambda lake: bucketed.BucketedFacts(lake.bronze, lake.customers, buckets=16).silver(),
    "silver_lab": lambda lake: lake.silver_lab,
    "distinct_rows": lambda lake: layers.distinct_rows(lake.raw),
    # Joins
    "join_inner_using": lambda lake: layers.enrich(
        lake.bronze, lake.customers.select("customer_id", "name", "created_at")),
    "join_broadcast": lambda lake: layers.enrich(
        lake.bronze, lake.customers.select("customer_id", "name", "created_at")),
    "join_cohort_back": lambda lake: layers.join_cohort_back(lake.silver, lake.customers).select(
        "transaction_id", "customer_id", "created_at"),
    "join_left_diagnose": lambda lake: layers.left_diagnose(lake.bronze, lake.customers).select(
        "transaction_id", "customer_id", "customer_segment", "matched"),
    "orphan_transactions": lambda lake: layers.orphan_transactions(lake.bronze, lake.customers),
    "dim_key_duplicates": lambda lake: layers.key_duplicates(lake.raw_customers, "customer_id"),
    # Aggregations
    "gold_fraud_risk": lambda lake: risk.gold_fraud_risk(lake.silver),
    "gold_channel_risk": lambda lake: risk.gold_channel_risk(lake.silver),
    "gold_category_risk": lambda lake: risk.gold_category_risk(lake.silver),
    "gold_daily_metrics": lambda lake: risk.gold_daily_metrics(lake.silver),
    "gold_daily_ymd": lambda lake: risk.gold_daily_ymd(lake.silver),
    "analysis_segment": lambda lake: risk.analysis_segment(lake.silver),
    "analysis_channel": lambda lake: risk.analysis_channel(lake.silver),
    "analysis_category": lambda lake: risk.analysis_category(lake.silver),
    "analysis_daily": lambda lake: risk.analysis_daily(lake.silver),
    "analysis_period": lambda lake: risk.analysis_period(lake.silver),
    "analysis_period_band": lambda lake: risk.analysis_period_band(lake.silver),
    "analysis_segment_band": lambda lake: risk.analysis_segment_band(lake.silver),
    "kpi_global": lambda lake: risk.kpi_global(lake.silver),
    "kpi_long": lambda lake: risk.kpi_long(lake.raw, lake.silver),
    "eda_score_by_segment": lambda lake: risk.eda_score_by_segment(lake.silver),
    "eda_risk_by_type": lambda lake: risk.eda_risk_by_type(lake.silver),
    "eda_day_of_month": lambda lake: risk.eda_day_of_month(lake.silver),
    "eda_cohort": lambda lake: risk.eda_cohort(lake.silver, as_of()),
    "eda_cross_sell": lambda lake: risk.eda_cross_sell(lake.silver, min_purchases=2),
    "profile_amount": lambda lake: quality.profile_amount(lake.bronze_lab),
    "profile_fraud": lambda lake: quality.profile_fraud(lake.bronze_lab),
    "duplicate_ids": lambda lake: quality.duplicate_ids(lake.raw),
    "silver_vs_bronze": lambda lake: counted_layers(lake).agg(
        *[F.coalesce(F.max(F.when(F.col("layer") == c, F.col("rows"))), F.lit(0)).alias(c) for c in ("silver", "bronze")]),
    "null_segment_count": lambda lake: quality.null_segment_count(lake.silver),
    "segment_preview": lambda lake: risk.segment_preview(lake.silver_lab),
    "gold_rollup_kpis": lambda lake: risk.gold_rollup_kpis(risk.gold_fraud_risk(lake.silver)),
    "pivot_band_segment": lambda lake: risk.pivot_band_segment(lake.silver),
    "gold_daily_top_fraud": lambda lake: risk.gold_daily_top_fraud(
        risk.gold_daily_ymd(lake.silver)),
    "quality_indicators": lambda lake: quality.quality_indicators(lake.raw),
    "risk_cube": lambda lake: risk.risk_cube(lake.silver),
    # Sorts and top-k
    "order_rate_desc": lambda lake: ordering.order_by(
        risk.gold_fraud_risk(lake.silver), ["-taxa_fraude_pct", "segment"]),
    "order_custom": lambda lake: ordering.order_listed(
        lake.silver.groupBy("channel").count(), "channel", CHANNEL_ORDER
    ).select("channel", F.col("count").alias("total"),
             ordering.rank_in("channel", CHANNEL_ORDER).alias("posicao")),
    "order_date": lambda lake: ordering.order_by(risk.gold_daily_metrics(lake.silver), ["data"]),
    "order_multi": lambda lake: ordering.order_by(
        measures.risk_by(lake.silver, ["segment", "amount_band"], total="rows", maior="amount_max"),
        ["segment", "amount_band"]),
    "top_k": lambda lake: ordering.top_k(
        lake.silver.select("transaction_id", "amount"), ["-amount", "transaction_id"], 5),
    "limit_sample": lambda lake: quality.preview(lake.silver, ["segment", "amount"]),
    # Models
    "ml_features": ml_inputs,
    "ml_category_index": lambda lake: ml.index_categories(
        ml.stored_inputs(lake.silver)).select(
        "transaction_id", *ml.CATEGORIES, *ml.CATEGORIES.values()),
    "ml_split": lambda lake: ml.stratified_split(ml_inputs(lake)).groupBy("is_fraud", "is_test").agg(
        F.count(F.lit(1)).alias("rows")),
    "ml_scaler": lambda lake: ml.scaler_stats(
        ml.index_categories(ml.stored_inputs(lake.silver)).filter(~F.col("is_test"))
    ).select("feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std")),
    "ml_class_weights": lambda lake: ml.class_weights(ml_train(lake)),
    "ml_logistic": lambda lake: test_scores(lake, "logistic"),
    "ml_threshold": lambda lake: ml.predict(test_scores(lake, "logistic")),
    "ml_random_forest": lambda lake: test_scores(lake, "forest"),
    "ml_logistic_facts": lambda lake: score_facts(lake, "logistic"),
    "ml_threshold_facts": threshold_facts,
    "ml_random_forest_facts": lambda lake: score_facts(lake, "forest"),
    "lr_coefficients_facts": gradient_facts,
    "rf_importances_facts": importance_facts,
    "model_metrics_facts": metric_facts,
    "batch_score_facts": batch_score_facts,
    "feed_models_facts": feed_model_facts,
    "roc_auc": lambda lake: ml.roc_auc(lake.silver, "risk_score", "is_fraud").select(
        F.round("auc", 6).alias("auc")),
    "confusion_matrix": lambda lake: ml.confusion(rule_prediction(lake), "is_fraud", "predicted"),
    "lr_coefficients": lambda lake: ml.coefficients(lake.spark, fitted(lake, "logistic")),
    "rf_importances": lambda lake: ml.importances(lake.spark, fitted(lake, "forest")),
    "model_metrics": lambda lake: deploy.train_models(lake.silver)["metrics"],
    "batch_score": batch_score,
    "threshold_sweep": lambda lake: ml.threshold_sweep(
        lake.silver, "risk_score", "is_fraud", SWEEP),
    # Dashboard feeds
    "feed_kpis": lambda lake: feeds.feed_kpis(lake.raw, lake.silver),
    "feed_channel": lambda lake: feeds.feed_channel(lake.silver),
    "feed_period": lambda lake: feeds.feed_period(lake.silver),
    "feed_category": lambda lake: feeds.feed_category(lake.silver),
    "feed_segment": lambda lake: feeds.feed_segment(lake.silver),
    "feed_heatmap": lambda lake: feeds.feed_heatmap(lake.silver),
    "feed_trend": lambda lake: feeds.feed_trend(lake.silver),
    "feed_models": lambda lake: ml.feed_models(deploy.train_models(lake.silver)),
    "feed_gold_panel": lambda lake: feeds.feed_gold_panel(risk.gold_fraud_risk(lake.silver)),
    "feed_segment_filter": lambda lake: feeds.feed_segment_filter(
        lake.silver, ["High-Risk", "Standard"]),
    # Risk insights
    "relative_risk": lambda lake: risk.relative_risk(lake.silver),
    "min_volume_guard": lambda lake: risk.min_volume_guard(
        lake.silver, ["time_period", "amount_band"], 300),
    "value_at_risk_rank": lambda lake: risk.value_at_risk_rank(lake.silver),
    "risk_mix": lambda lake: risk.risk_mix(lake.silver),
    "daily_rate_alert": lambda lake: risk.daily_rate_alert(lake.silver),
    "partition_latency": partition_latency,
    "partition_latency_facts": latency_facts,
    "partition_monitor": lambda lake: quality.partition_monitor(lake.raw_parts),
    # Exports
    **{f"export_{name}": exported_analysis(name) for name in [*lake_plans.ANALYSES, "kpis"]},
    "export_models_facts": exported_model_facts,
    # Streams
    "stream_bronze": stream_bronze,
    "stream_silver": stream_silver,
    "stream_rejects": stream_rejects,
    "stream_risk_windows": lambda lake: stream_windows(lake, "1 day"),
    "stream_risk_windows_sliding": lambda lake: stream_windows(lake, "12 hours", "6 hours"),
    "stream_decision": stream_decision,
    "stream_model_decision": stream_model_decision,
    "stream_model_decision_facts": stream_model_facts,
    "stream_gold_upsert": stream_gold_upsert,
    # Incremental maintenance
    "incremental_gold": incremental_gold,
    **{f"{name}_from_base": gold_from_stored_base(name) for name in risk.GOLD_FROM_BASE},
    "analysis_segment_from_base": lambda lake: risk.segment_from_base(
        incremental.read_customer_base(lake.spark, stored_base(lake))),
    "compact_batches": compact_batches,
    "incremental_ingest": incremental_ingest,
    "compact_partition": compact_partition,
}


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    prepare(spark)
    return QUERIES[name](Lake.from_tables(spark, folder))
