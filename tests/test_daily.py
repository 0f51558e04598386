import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from moodline.operators import daily

DAY = dt.date(2024, 1, 1)
LABELS = {"positive": 1, "neutral": 0, "negative": -1, None: None, "odd": None}


def sample(n=400, seed=2):
    rng = random.Random(seed)
    days = [DAY + dt.timedelta(days=rng.choice([0, 1, 2, 3, 5, 8, 13])) for _ in range(n)]
    return [
        (None if rng.random() < 0.05 else d, rng.choice("ab"), rng.choice(list(LABELS))) for d in days
    ]


@pytest.fixture(scope="module")
def signals(spark):
    return spark.createDataFrame(sample(), "date date, candidate string, sentiment_label string")


def frame():
    pdf = pd.DataFrame(sample(), columns=["date", "candidate", "label"])
    pdf["indic"] = pdf["label"].map(LABELS).astype("float")
    return pdf


def test_ratio_long(spark, signals):
    want = frame().groupby(["date", "candidate"])["indic"].agg(["sum", "count"])
    got = daily.daily_ratio_long(signals, ["a", "b"]).collect()
    assert len(got) == len(want)
    for r in got:
        w = want.loc[(r["date"], r["candidate"])]
        assert (r["sum"], r["count"]) == (w["sum"], w["count"])
        assert r["ratio"] == pytest.approx(w["sum"] / w["count"]) and -1 <= r["ratio"] <= 1


def test_ratio_of_a_day_without_labels(spark):
    df = spark.createDataFrame([(DAY, "a", None)], "date date, candidate string, sentiment_label string")
    row = daily.daily_ratio_long(df, ["a"]).first()
    assert (row["sum"], row["count"], row["ratio"]) == (0, 0, None)
    one = daily.daily_ratio_one(df).first()
    assert (one["sum"], one["count"], one["ratio"]) == (0, 0, None)


def test_wide_counts_rows_without_mention(spark):
    data = [
        (DAY, "positive", "neutral", 1, 0),
        (DAY, "neutral", "negative", 0, 1),
        (DAY, "positive", None, 1, 0),
        (None, "positive", "positive", 1, 1),
    ]
    df = spark.createDataFrame(
        data, "date date, a_sentiment_label string, b_sentiment_label string, mentions_a int, mentions_b int"
    )
    row = daily.daily_ratio_wide(df, ["a", "b"]).collect()
    assert len(row) == 1 and row[0]["a_ratio"] == pytest.approx(2 / 3) and row[0]["b_ratio"] == -0.5
    only = daily.daily_ratio_wide(df, ["a", "b"], mentions_only=True).first()
    assert (only["a_ratio"], only["b_ratio"]) == (1.0, -1.0)


def test_wide_is_long_if_all_rows_mention(spark, signals):
    wide = signals.select(
        "date",
        *[F.when(F.col("candidate") == e, F.col("sentiment_label")).alias(f"{e}_sentiment_label") for e in "ab"],
        *[F.lit(1).alias(f"mentions_{e}") for e in "ab"],
    )
    a = {r["date"]: (r["a_ratio"], r["b_ratio"]) for r in daily.daily_ratio_wide(wide, "ab").collect()}
    long = daily.daily_ratio_long(signals, ["a", "b"])
    b = {r["date"]: (r["a"], r["b"]) for r in daily.pivot_entities(long, ["a", "b"], ["ratio"]).collect()}
    assert a == b


@pytest.mark.parametrize("per_entity", [False, True])
def test_trailing_mean(spark, signals, per_entity):
    means = daily.daily_mean(signals, ["a", "b"])
    order = ["date"] if per_entity else ["date", "candidate"]
    per = ["candidate"] if per_entity else []
    got = means.withColumn("r", daily.trailing_mean("sentiment_indic", order, per=per)).collect()
    pdf = frame().groupby(["date", "candidate"])["indic"].mean().reset_index().sort_values(["date", "candidate"])
    rolled = (
        pdf.groupby("candidate")["indic"].transform(lambda s: s.rolling(7, min_periods=1).mean())
        if per_entity
        else pdf["indic"].rolling(7, min_periods=1).mean()
    )
    want = dict(zip(zip(pdf["date"], pdf["candidate"]), rolled))
    assert {(r["date"], r["candidate"]): r["r"] for r in got} == pytest.approx(want)


def test_trailing_mean_skips_nulls(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "date int, x double")
    got = [r[0] for r in df.select(daily.trailing_mean("x", ["date"])).collect()]
    assert got == [1.0, 1.0, 2.0]


def test_pivot(spark):
    schema = "date date, candidate string, ratio double, other double"
    df = spark.createDataFrame([(DAY, "a", 0.5, 1.0)], schema)
    row = daily.pivot_entities(df, ["a", "b"], ["ratio", "other"]).first().asDict()
    assert row == {"date": DAY, "a": 0.5, "b": None, "a_other": 1.0, "b_other": None}
    twice = df.unionAll(df)
    with pytest.raises(Exception, match="more than one row per day for a"):
        daily.pivot_entities(twice, ["a", "b"], ["ratio"]).collect()
