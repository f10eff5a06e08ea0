"""Features, split, models and evaluation."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lakerisk.operators import ml
from lakerisk.plans.lake import Lake


@pytest.fixture(scope="module")
def models(spark):
    silver = Lake.from_tables(spark, "/root/testdata/sf0.01").silver
    return ml.train_models(silver)


def brute_auc(pairs):
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("distinct", [3, 40, 100000])
def test_auc_equals_all_pairs(spark, distinct):
    rng = random.Random(distinct)
    pairs = [(rng.randrange(distinct) / 7.0, rng.random() < 0.3) for _ in range(600)]
    df = spark.createDataFrame(pairs, "s double, y boolean")
    assert ml.roc_auc(df, "s", "y").first()["auc"] == pytest.approx(brute_auc(pairs), abs=1e-12)


def test_auc_equals_the_evaluator(spark, lake):
    df = lake.silver.select(F.col("risk_score").alias("s"), F.col("is_fraud").cast("double").alias("y"))
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0)
    assert ml.roc_auc(df, "s", "y").first()["auc"] == pytest.approx(evaluator.evaluate(df), abs=1e-9)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1.0, True), (2.0, True)], "s double, y boolean")
    assert ml.roc_auc(df, "s", "y").first()["auc"] is None


def test_confusion_has_all_cells(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 0)], "y int, p int")
    assert [tuple(r) for r in ml.confusion(df, "y", "p").collect()] == [
        ("Real 0 — não fraude", 0, 0), ("Real 1 — fraude", 1, 2)]


def test_sweep_against_plain_counting(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(0, 20) * 5.0, rng.random() < 0.2) for _ in range(400)]
    cuts = [-1.0, 0.0, 50.0, 95.0, 500.0]
    got = ml.threshold_sweep(spark.createDataFrame(rows, "s double, y boolean"), "s", "y", cuts).collect()
    for row in got:
        alerts = [y for s, y in rows if s >= row["threshold"]]
        assert (row["alerts"], row["hits"]) == (len(alerts), sum(alerts))
        assert row["precision"] == (None if not alerts else pytest.approx(sum(alerts) / len(alerts), abs=1e-6))
        assert row["recall"] == pytest.approx(sum(alerts) / sum(y for _, y in rows), abs=1e-6)
    assert [r["threshold"] for r in got] == cuts


def test_split_is_repeatable_and_disjoint(lake):
    rows = ml.ml_input(lake.silver)
    a = ml.stratified_split(rows).select("transaction_id", "is_test")
    b = ml.stratified_split(rows.repartition(5)).select("transaction_id", "is_test")
    assert a.exceptAll(b).isEmpty()
    other = ml.stratified_split(rows, salt=7).select("transaction_id", "is_test")
    assert not a.exceptAll(other).isEmpty()


def test_exact_split_keeps_the_share_of_each_class(spark):
    lake = Lake.from_tables(spark, "/root/testdata/sf0.01")
    split = ml.stratified_split(ml.ml_input(lake.silver), exact=True)
    shares = split.groupBy("is_fraud").agg(F.avg(F.col("is_test").cast("int")).alias("share")).collect()
    assert len(shares) == 2
    for row in shares:
        assert row["share"] == pytest.approx(0.25, abs=0.005)


def test_balanced_weights_sum_to_the_rows(lake):
    train = ml.ml_input(lake.silver)
    weighted = ml.add_balanced_weights(train).groupBy("label").agg(F.sum("weight").alias("w")).collect()
    half = train.count() / 2
    assert [r["w"] for r in weighted] == [pytest.approx(half), pytest.approx(half)]


def test_models_rank_better_than_chance(models):
    auc = {r["modelo"]: r["auc"] for r in models["metrics"].collect()}
    assert set(auc) == {ml.LOGISTIC_NAME, ml.FOREST_NAME}
    assert all(0.6 < v <= 1.0 for v in auc.values())


def test_model_tables(models):
    coefficients = {r["feature"]: r["coefficient"] for r in models["coefficients"].collect()}
    importances = {r["feature"]: r["importance"] for r in models["importances"].collect()}
    assert list(coefficients) == ml.FEATURES and list(importances) == ml.FEATURES
    assert sum(importances.values()) == pytest.approx(1.0)
    assert max(coefficients, key=lambda k: abs(coefficients[k])) == "risk_score"
    confusion = models["confusion"].collect()
    assert [r["classe"] for r in confusion] == list(ml.REAL_LABELS)
    assert ml.feed_models(models).count() == 2 + 4 + 6 + 6


def test_review_queue_is_sorted_and_whole(lake):
    table = ml.training_table(lake.silver)
    train, _ = ml.split_sides(table)
    rows = ml.review_queue(ml.score_transactions(table, ml.fit_logistic(train))).collect()
    scores = [r["score"] for r in rows]
    assert len(rows) == lake.silver.count() and scores == sorted(scores, reverse=True)


@pytest.mark.parametrize("fit", [ml.fit_logistic, ml.fit_forest])
def test_models_score_in_a_session_that_observed_a_frame(spark, fit):
    """Such a session cannot go to the tasks, so a fitted model must not hold it."""
    seen = Observation("rows")
    spark.range(10).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get["n"] == 10
    values = [[1.0, 20.0, 500.0, 0.0, 1.0, 2.0], [9.0, 80.0, 400.0, 1.0, 0.0, 2.0], [2.0, 30.0, 650.0, 0.0, 1.0, 1.0], [8.0, 90.0, 350.0, 1.0, 2.0, 0.0]]
    rows = [(i, *v, float(i % 2), 1.0) for i, v in enumerate(values)]
    table = ml.assemble(spark.createDataFrame(rows, ["transaction_id", *ml.FEATURES, "label", "weight"]))
    model = fit(table)
    scores = {r["transaction_id"]: r["score"] for r in ml.score_transactions(table, model).collect()}
    assert len(scores) == 4 and all(0 <= s <= 1 for s in scores.values())
