"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then five times; the median counts. Results are forced with a
``noop`` write. ``queries`` derives Silver from the given tables every time; ``stored`` reads a Silver
written once to the scratch folder; ``heavy`` has the models, the stream and the incremental run, which
run twice after the warm-up and are not part of the total.
"""

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lakerisk.plans import catalog  # noqa: E402
from lakerisk.plans.lake import Lake, LakePaths, StoredLake, build_layers  # noqa: E402
from lakerisk.session import prepare, shared_dir  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))

HEADLINE = [
    "bronze_transactions", "silver_transactions",
    "gold_fraud_risk", "gold_channel_risk", "gold_category_risk", "gold_daily_metrics",
    "analysis_segment", "analysis_channel", "analysis_category", "analysis_daily",
    "analysis_period", "analysis_period_band", "analysis_segment_band", "kpi_global",
    "eda_score_by_segment", "eda_risk_by_type", "eda_day_of_month", "eda_cohort",
    "eda_cross_sell", "risk_cube", "bronze_rejects", "quality_indicators", "roc_auc",
]
STORED = HEADLINE
HEAVY = ["model_metrics", "stream_silver", "incremental_gold"]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def seconds(name: str, lake) -> float:
    start = time.perf_counter()
    result: DataFrame = catalog.QUERIES[name](lake())
    result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def median(name: str, lake, runs: int = RUNS) -> float:
    seconds(name, lake)
    return round(statistics.median(seconds(name, lake) for _ in range(runs)), 4)


def main() -> None:
    spark = session()
    paths = LakePaths(shared_dir(spark, "bench"))
    start = time.perf_counter()
    build_layers(Lake.from_tables(spark, FOLDER), paths)
    build = round(time.perf_counter() - start, 4)

    derived = lambda: Lake.from_tables(spark, FOLDER)
    stored = lambda: StoredLake(spark, paths)
    queries = {name: median(name, derived) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline queries, total of median seconds",
        "value": round(sum(queries.values()), 4),
        "unit": "sec",
        "queries": queries,
        "stored": {name: median(name, stored) for name in STORED},
        "heavy": {name: median(name, derived, 2) for name in HEAVY},
        "build_layers": build,
        "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
