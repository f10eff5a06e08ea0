"""Edges of the derived columns."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakerisk.functions import derive


def one(spark, value, ddl, build):
    return spark.createDataFrame([(value,)], f"x {ddl}").select(build(F.col("x")).alias("r")).first()["r"]


@pytest.mark.parametrize("amount,band", [
    (0.0, "baixo"), (0.01, "baixo"), (99.99, "baixo"), (100.0, "medio"), (999.99, "medio"),
    (1000.0, "alto"), (None, "alto")])
def test_amount_band(spark, amount, band):
    assert one(spark, amount, "double", derive.amount_band) == band


@pytest.mark.parametrize("hour,period", [
    (0, "madrugada"), (5, "madrugada"), (6, "manha"), (11, "manha"), (12, "tarde"), (17, "tarde"),
    (18, "noite"), (23, "noite"), (None, "madrugada")])
def test_time_period(spark, hour, period):
    assert one(spark, hour, "int", derive.time_period) == period


@pytest.mark.parametrize("days,label", [
    (0, "cliente novo"), (365, "cliente novo"), (366, "cliente antigo"), (None, "cliente novo")])
def test_cohort(spark, days, label):
    today = dt.date(2024, 2, 1)
    created = None if days is None else today - dt.timedelta(days=days)
    got = one(spark, created, "date", lambda c: derive.cohort(c, F.lit("2024-02-01").cast("date")))
    assert got == label


@pytest.mark.parametrize("text,value", [
    ("True", True), ("true", True), (" TRUE ", True), ("False", False), ("no", False), (None, None)])
def test_normalize_bool(spark, text, value):
    assert one(spark, text, "string", derive.normalize_bool) is value


def test_weekdays_count_from_sunday(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d),) for d in range(7, 14)], "ts timestamp_ntz")
    rows = derive.add_iso_weekday(derive.add_date_parts(df)).orderBy("ts").collect()
    assert [r["day_of_week"] for r in rows] == [0, 1, 2, 3, 4, 5, 6]
    assert [r["iso_weekday"] for r in rows] == [7, 1, 2, 3, 4, 5, 6]
    shifted = derive.add_date_parts(df, dow_base=1).orderBy("ts").collect()
    assert [r["day_of_week"] for r in shifted] == [1, 2, 3, 4, 5, 6, 7]
