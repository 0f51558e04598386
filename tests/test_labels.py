import datetime as dt

import pytest

from moodline.operators import labels as L


def test_toplines(spark):
    df = spark.createDataFrame([("11/3/2020", 0.25, 0.75)], "modeldate string, ecwin_inc double, ecwin_chal double")
    assert L.topline_labels(df).first().asDict() == {
        "date": dt.date(2020, 11, 3),
        "p_win": 0.25,
        "p_lose": 0.75,
    }


def test_forecast(spark):
    ok = ("2024-10-01", None, "electoral college", "p_win")
    data = [
        (*ok, "REP", 0.4),
        (*ok, "DEM", 0.5),
        (*ok, "IND", 0.1),
        ("2024-10-02", None, "electoral college", "p_win", "DEM", 1.0),
        ("2024-10-01", "OH", "electoral college", "p_win", "REP", 0.9),
        ("2024-10-01", None, "popular vote", "p_win", "REP", 0.9),
        ("2024-10-01", None, "electoral college", "mean", "REP", 0.9),
    ]
    df = spark.createDataFrame(
        data, "model_date string, state_abb string, variable string, metric string, party string, value double"
    )
    got = {r["date"].day: (r["p_win"], r["p_lose"]) for r in L.forecast_labels(df).collect()}
    assert got == {1: (0.4, 0.6), 2: (0.0, 1.0)}


def prices(spark):
    return spark.createDataFrame(
        [("2024-10-01", 0.25, 0.5)],
        "`Date (ET)` string, `Close Share Price` double, `Average Trade Price` double",
    )


def test_market(spark):
    close = L.market_labels(prices(spark)).first()
    assert (close["p_win"], close["p_lose"]) == (0.25, 0.75)
    assert L.market_labels(prices(spark), "average").first()["p_win"] == 0.5
    with pytest.raises(ValueError):
        L.market_labels(prices(spark), "open")


def test_dispatch(spark):
    tables = L.LabelTables(market=prices(spark))
    for split in (L.TRAIN, L.TEST):
        assert L.label_series(tables, L.MARKET, split=split).count() == 1
    assert L.label_series(tables, L.FORECAST, split=L.TEST, market_only=True).count() == 1
    with pytest.raises(ValueError):
        L.label_series(tables, "poll")


def test_join(spark):
    day = dt.date(2024, 10, 1)
    features = spark.createDataFrame([(day, 1.0), (dt.date(2024, 10, 2), 2.0)], "date date, x double")
    labels = L.market_labels(prices(spark))
    assert [tuple(r) for r in L.join_labels(features, labels).collect()] == [(day, 1.0, 0.25)]
    twice = labels.unionAll(labels)
    assert L.join_labels(features, twice).count() == 2
    with pytest.raises(Exception, match="more than one label on 2024-10-01"):
        L.join_labels(features, twice, on_duplicate="error").collect()
    with pytest.raises(ValueError):
        L.join_labels(features, labels, on_duplicate="first")
