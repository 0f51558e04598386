import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodline.functions import measures as M
from moodline.functions import time as D


def test_threshold_label(spark):
    values = [0.05, -0.05, 0.0, None, float("nan"), 0.049, -1.0, 1.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s double")
    got = [r[0] for r in df.orderBy("i").select(M.threshold_label("s")).collect()]
    assert got == ["positive", "negative", *["neutral"] * 4, "negative", "positive"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1, 1), min_size=5, max_size=30))
def test_label_grows_with_the_score(values):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(v,) for v in sorted(values)], "s double").coalesce(1)
    got = [r[0] for r in df.select(M.label_indicator(M.threshold_label("s"))).collect()]
    assert got == sorted(got)


def test_label_indicator(spark):
    df = spark.createDataFrame([("Positive",), ("neutral",), ("NEGATIVE",), ("x",), (None,)], "l string")
    assert [r[0] for r in df.select(M.label_indicator("l")).collect()] == [1, 0, -1, None, None]


def test_entity_indicator(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    assert [r[0] for r in df.select(M.entity_indicator("c", "a")).collect()] == [1, 0, 0]


def test_softmax_and_top_label(spark):
    df = spark.createDataFrame([([0.1, 2.0, 2.0],), ([1000.0, 0.0, -5.0],), (None,)], "a array<double>")
    rows = df.select(M.softmax("a").alias("p"), M.top_label("a").alias("l")).collect()
    assert [r["l"] for r in rows] == ["neutral", "negative", None]
    assert math.isclose(sum(rows[0]["p"]), 1.0)
    assert rows[1]["p"][0] == 1.0 and rows[2]["p"] is None


def test_small_measures(spark):
    df = spark.createDataFrame([(0.5,), (-1.0,), (None,)], "x double")
    rows = df.select(M.softsign("x"), M.complement("x"), M.binarise("x")).collect()
    assert [tuple(r) for r in rows] == [(1 / 3, 0.5, 0), (-0.5, 2.0, 0), (None, None, 0)]


def test_account_age(spark):
    t = dt.datetime
    rows = [
        (t(2020, 1, 1, 0), t(2020, 1, 1, 6), -1),
        (t(2020, 1, 2, 1), t(2020, 1, 1, 23), 0),
        (t(2020, 1, 3, 0), t(2020, 1, 1, 0), 2),
        (None, t(2020, 1, 1), None),
    ]
    df = spark.createDataFrame(rows, "a timestamp, b timestamp, want long")
    assert all(r[0] == r[1] for r in df.select(D.account_age_days("a", "b"), "want").collect())


def test_parsing(spark):
    df = spark.createDataFrame([("2020-11-03",), ("11/3/2020",), ("nonsense",), (None,)], "s string")
    got = [r[0] for r in df.select(D.parse_date("s", ["M/d/yyyy"])).collect()]
    assert got == [dt.date(2020, 11, 3), dt.date(2020, 11, 3), None, None]
    stamp = df.limit(3).select(D.parse_timestamp("s"), D.parse_timestamp("s", "M/d/yyyy")).collect()
    assert stamp[0][0] == dt.datetime(2020, 11, 3) and stamp[2][0] is None
    assert stamp[1][1] == dt.datetime(2020, 11, 3)


def test_epoch(spark):
    df = spark.createDataFrame([(1700000000123,)], "ms long")
    row = df.select(
        D.to_epoch_ms(D.from_epoch_ms("ms")).alias("ms"), D.utc_day(D.from_epoch_ms("ms")).alias("d")
    ).first()
    assert row["ms"] == 1700000000123 and row["d"] == dt.date(2023, 11, 14)


@pytest.mark.parametrize(("total", "count", "want"), [(3, 4, 0.75), (0, 0, None)])
def test_ratio(spark, total, count, want):
    assert spark.range(1).select(M.ratio_of(F.lit(total), F.lit(count))).first()[0] == want
