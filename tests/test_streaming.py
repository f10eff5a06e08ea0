"""Streams against their batch twins, and lateness."""

import datetime as dt

from pyspark.sql import functions as F

from lakerisk.operators import layers, ml, risk
from lakerisk.plans import catalog
from lakerisk.plans import incremental as inc
from lakerisk.plans.lake import LakePaths
from lakerisk.schemas import TX_SCHEMA
from lakerisk.streaming import stream
from tests.test_layers import CUSTOMER, cust, tx


def deliver(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def raw_stream(spark, path):
    return spark.readStream.schema(TX_SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def at(day, hour, **more):
    return {"timestamp": dt.datetime(2024, 1, day, hour), **more}


def test_key_dedup_and_rules(spark, scratch):
    deliver(tx(spark, at(1, 1), at(1, 1), at(1, 1, amount=99.0), at(1, 2, transaction_id=2, amount=-1.0)), scratch("in"))
    out = stream.run_available(stream.stream_bronze(raw_stream(spark, scratch("in"))), spark, "t")
    assert [r["transaction_id"] for r in out.collect()] == [1]


def test_duplicate_in_a_later_file_is_dropped(spark, scratch):
    deliver(tx(spark, at(1, 1)), scratch("in"))
    deliver(tx(spark, at(1, 1), at(1, 2, transaction_id=2)), scratch("in"))
    out = stream.run_available(stream.stream_bronze(raw_stream(spark, scratch("in"))), spark, "t")
    assert sorted(r["transaction_id"] for r in out.collect()) == [1, 2]


def test_row_behind_the_watermark_is_dropped(spark, scratch):
    deliver(tx(spark, at(10, 1)), scratch("in"))
    deliver(tx(spark, at(10, 2, transaction_id=2)), scratch("in"))
    deliver(tx(spark, at(1, 1, transaction_id=3)), scratch("in"))
    out = stream.run_available(stream.stream_bronze(raw_stream(spark, scratch("in"))), spark, "t")
    assert sorted(r["transaction_id"] for r in out.collect()) == [1, 2]


def test_windows_over_several_files_equal_batch(spark, scratch):
    rows = [at(d, h, transaction_id=100 * d + h, is_fraud=h % 5 == 0) for d in range(1, 6) for h in range(24)]
    for day in range(5):
        deliver(tx(spark, *rows[24 * day:24 * (day + 1)]), scratch("in"))
    customers = layers.bronze_customers(cust(spark, CUSTOMER))
    silver = stream.stream_silver(stream.stream_bronze(raw_stream(spark, scratch("in"))), customers)
    out = stream.run_available(stream.stream_risk_windows(silver, "1 day"), spark, "t").orderBy("inicio").collect()
    # The last day is still open when the input ends.
    assert [(r["inicio"].day, r["transacoes"], r["fraudes"]) for r in out] == [(d, 24, 5) for d in range(1, 5)]


def test_decision_cuts(spark):
    df = spark.createDataFrame([(89.99,), (90.0,), (60.0,), (59.9,), (None,)], "s double")
    got = [r["d"] for r in df.select(stream.decision(F.col("s"), 90.0, 60.0).alias("d")).collect()]
    assert got == ["review", "deny", "review", "approve", "review"]


def test_model_decision_on_a_stream(spark, lake, scratch):
    table = ml.training_table(lake.silver)
    train, _ = ml.split_sides(table)
    model = ml.fit_logistic(train)
    rows = ml.index_categories(lake.silver).select("transaction_id", "ts", *ml.FEATURES)
    rows.write.parquet(scratch("in"))
    source = spark.readStream.schema(rows.schema).parquet(scratch("in"))
    out = stream.run_available(stream.stream_model_decision(source, model), spark, "t")
    assert out.count() == rows.count()
    assert {r["decisao"] for r in out.select("decisao").distinct().collect()} <= {"approve", "review", "deny"}
    wrong = out.filter((F.col("score") >= 0.8) != (F.col("decisao") == "deny"))
    assert wrong.isEmpty()


def test_stream_source_reads_the_whole_table(spark, lake):
    assert catalog.raw_stream(lake).isStreaming
    out = stream.run_available(catalog.raw_stream(lake), spark, "t")
    assert out.count() == lake.raw.count()


def test_a_second_stream_adds_to_the_lake(spark, lake, scratch):
    """Two streams into one lake, and micro-batches numbered alike, end as one full run."""
    paths = LakePaths(scratch("lake"))
    silver = lake.silver.withColumn("event_time", F.to_timestamp("ts"))
    for part in range(2):
        silver.filter(f"transaction_id % 2 = {part}").write.parquet(scratch(f"in{part}"))
        source = spark.readStream.schema(silver.schema).parquet(scratch(f"in{part}"))
        stream.stream_gold_upsert(source, paths, scratch(f"checkpoint{part}"))
    got = inc.gold_from_base(inc.read_base(spark, paths), ["data", "segment"])
    want = inc.gold_from_base(risk.additive_base(lake.silver), ["data", "segment"])
    assert got.exceptAll(want.select(got.columns)).isEmpty() and got.count() == want.count()


def test_shuffled_backlog_over_several_triggers_equals_batch(spark, lake, scratch):
    raw = lake.raw.withColumn("part", F.pmod(F.xxhash64("transaction_id"), F.lit(4))).persist()
    for part in range(4):
        deliver(raw.filter(f"part = {part}").drop("part"), scratch("in"))
    deliver(lake.raw.limit(50), scratch("in"))  # delivered again
    silver_of = lambda new: stream.stream_silver(new, lake.customers)
    for length, slide in (("1 day", None), ("12 hours", "6 hours")):
        out, path = scratch(f"out {length}"), scratch(f"windows {length}")
        parts = stream.store_batches(path, lambda new: stream.window_parts(silver_of(new), length, slide))
        stream.land(raw_stream(spark, scratch("in")), out, scratch(f"checkpoint {length}"), then=parts)
        got, want = stream.read_bronze(spark, out), lake.bronze
        assert got.count() == want.count() and got.exceptAll(want.select(got.columns)).isEmpty()
        account = stream.read_account(spark, out).first()
        assert account["raw"] == lake.raw.count() + 50 and account["emitted"] == want.count()
        assert account["raw"] == account["emitted"] + account["copies"] + account["rejects"]
        windows = stream.windows_from_parts(spark.read.parquet(path))
        whole = stream.windows_from_parts(stream.window_parts(lake.silver, length, slide))
        assert windows.count() == whole.count() and windows.exceptAll(whole).isEmpty()
        start = F.window(F.to_timestamp("ts"), length, slide)["start"].cast("timestamp_ntz").alias("inicio")
        assert whole.count() == lake.silver.select(start, "segment").distinct().count()


def test_late_row_lands_in_its_closed_window(spark, scratch):
    deliver(tx(spark, at(10, 1)), scratch("in"))
    deliver(tx(spark, at(10, 2, transaction_id=2)), scratch("in"))
    deliver(tx(spark, at(1, 1, transaction_id=3), at(10, 1), at(1, 2, transaction_id=4, amount=-1.0)), scratch("in"))
    path = scratch("out")
    stream.land(raw_stream(spark, scratch("in")), path, scratch("checkpoint"))
    assert sorted(r["transaction_id"] for r in stream.read_bronze(spark, path).collect()) == [1, 2, 3]
    assert stream.read_account(spark, path).first().asDict() == {"raw": 5, "emitted": 3, "rejects": 1, "copies": 1}
