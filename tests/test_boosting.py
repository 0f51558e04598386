"""Boosting against a plain fit on the same bins, on the driver and on Spark."""

import numpy as np
import pytest

from moodline.operators import boosting as B
from moodline.operators import models as M


def plain(x, y, cuts, trees, depth, step):
    """Rows, not cells; every split tried."""
    f = np.full(len(y), y.mean())
    tie = B.TIE * ((y - y.mean()) ** 2).sum()

    def tree(rows, depth):
        r = y[rows] - f[rows]
        best = None
        if depth:
            for k, own in enumerate(cuts):
                for c in own:
                    go = x[rows, k] <= c
                    if go.any() and not go.all():
                        gain = r[go].sum() ** 2 / go.sum() + r[~go].sum() ** 2 / (~go).sum() - r.sum() ** 2 / len(r)
                        if gain > tie and (best is None or gain > best[0] + tie):
                            best = (gain, k, c)
        if not best:
            return [(rows, r.mean())]
        go = x[rows, best[1]] <= best[2]
        return tree(rows[go], depth - 1) + tree(rows[~go], depth - 1)

    for _ in range(trees):
        for rows, value in tree(np.arange(len(y)), depth):
            f[rows] += step * value
    return f


def data(n=300, seed=2):
    draw = np.random.default_rng(seed)
    x = np.stack([draw.integers(0, 12, n) / 4, draw.normal(size=n).round(2), np.full(n, 7.0)], axis=1)
    return x, np.sin(2 * x[:, 0]) + (x[:, 1] > 0.3) + 0.1 * draw.normal(size=n)


def table(spark, x, y):
    rows = [(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)]
    return spark.createDataFrame(rows, "a double, b double, c double, y double").repartition(5)


@pytest.mark.parametrize("trees, depth, bins", [(20, 2, 64), (50, 3, 16), (100, 1, 300), (0, 2, 64), (3, 6, 64)])
def test_same_as_plain(spark, trees, depth, bins):
    x, y = data()
    df = table(spark, x, y)
    model = B.fit(df, "y", ["a", "b", "c"], trees, depth, 0.1, bins)
    assert all(len(c) < bins for c in model.cuts) and len(model.cuts[2]) == 0
    assert np.allclose(model.predict(x), plain(x, y, model.cuts, trees, depth, 0.1), atol=1e-9)
    got = df.withColumn("prediction", B.prediction(["a", "b", "c"], model)).toPandas()
    assert np.allclose(got["prediction"], model.predict(got[["a", "b", "c"]].to_numpy()))


def test_all_cuts_of_few_values(spark):
    x, y = data()
    cuts = B.choose_cuts(table(spark, x, y), ["a", "b", "c"])
    values = np.unique(x[:, 0])
    assert np.allclose(cuts[0], (values[1:] + values[:-1]) / 2) and len(cuts[1]) <= 64
    counts = np.bincount(np.searchsorted(cuts[1], x[:, 1]))
    assert counts.max() <= 3 * len(x) / 64 + 5


def test_on_spark_as_on_the_driver(spark):
    x, y = data(120)
    df = table(spark, x, y)
    near, far = (B.fit(df, "y", ["a", "b"], 4, 2, 0.3, most_cells=m) for m in (10**6, 0))
    assert [[(n.feature, n.cut) for n in t] for t in near.trees] == [[(n.feature, n.cut) for n in t] for t in far.trees]
    assert np.allclose(near.predict(x), far.predict(x), atol=1e-9)


def test_equal_features_and_repartitioning(spark):
    x, y = data()
    x[:, 2] = x[:, 0]  # an equal of the first one: never chosen
    models = [B.fit(table(spark, x, y).repartition(k), "y", ["a", "b", "c"], 10, 3) for k in (1, 7)]
    assert all(n.feature != 2 for m in models for t in m.trees for n in t)
    assert np.allclose(models[0].predict(x), models[1].predict(x), atol=1e-12)


def test_awkward(spark):
    x, y = data(50)
    constant = B.fit(table(spark, x, np.full(50, 0.25)), "y", ["a", "b"], 5)
    assert np.allclose(constant.predict(x), 0.25)
    with pytest.raises(ValueError, match="missing"):
        B.fit(table(spark, np.where(x == x[0, 1], np.nan, x), y), "y", ["a", "b"], 1)
    with pytest.raises(ValueError, match="no rows"):
        B.fit(table(spark, x, y).limit(0), "y", ["a"], 1)
    fit = M.fit_model(table(spark, x, y).withColumnRenamed("y", "p_win"), "Gradient Boosting", n_estimators=5, max_depth=2)
    assert fit.predictions.columns[-1] == "prediction" and fit.predictions.count() == 50
