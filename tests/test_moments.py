"""Fits from moments against Spark ML and numpy; a whole path of penalties."""

import numpy as np
import pytest

from moodline.operators import models as M
from moodline.operators import moments as G

N = 90
DRAW = np.random.default_rng(8)
X = DRAW.normal(size=(N, 3)) @ np.array([[1, 0.4, 0], [0, 2.0, 0], [0.3, 0, 0.5]]) + [1e4, -3, 0.2]
Y = (X - X.mean(0)) @ [0.3, -0.2, 0.0] + 0.6 + 0.05 * DRAW.normal(size=N)


def table(spark, x=X, y=Y):
    rows = [(i, *map(float, r), float(v), 1 - float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "date int, a double, b double, c double, p_win double, p_lose double").repartition(4)


@pytest.mark.parametrize(
    "name, options",
    [("OLS", {}), ("Linear Regression", {}), ("OLS no intercept", {}), ("Ridge", {"alpha": 3.0}), ("Lasso", {"alpha": 0.05}), ("Lasso", {"alpha": 9.0})],
)
def test_same_as_spark_ml(spark, name, options):
    df = table(spark)
    m = G.moments(df, ["a", "b", "c", "p_win", "p_lose"])
    got = G.FROM_MOMENTS[name](m, "p_win", ["a", "b", "c"], **options)
    want = M.fit_model(df, name, **options)
    assert got.betas.keys() == want.betas.keys()
    for k, v in want.betas.items():
        assert got.betas[k] == pytest.approx(v, abs=1e-6, rel=1e-6)
    assert got.r2 == pytest.approx(want.r2, abs=1e-6)


def test_path(spark):
    alphas = [1.0, 0.3, 0.1, 0.01, 0.001, 0.0]
    rows = G.penalty_path(table(spark), ["p_win", "p_lose"], ["a", "b", "c"], {"Lasso": alphas, "Ridge": alphas}).collect()
    assert len(rows) == 2 * 2 * 6 * 4
    xc, yc = X - X.mean(0), Y - Y.mean()
    for alpha in alphas:
        of = {(r.label, r.model, r.feature): r.beta for r in rows if r.alpha == alpha}
        w = np.array([of["p_win", "Lasso", f] for f in "abc"])
        # the conditions of a minimum
        slope = xc.T @ (yc - xc @ w) / N
        assert (np.abs(slope) <= alpha + 1e-9).all() and np.allclose(slope[w != 0], alpha * np.sign(w[w != 0]), atol=1e-9)
        ridge = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
        assert np.allclose([of["p_win", "Ridge", f] for f in "abc"], ridge, atol=1e-8)
        for f in "abc":
            assert of["p_lose", "Lasso", f] == pytest.approx(-of["p_win", "Lasso", f], abs=1e-9)
    with pytest.raises(ValueError, match="no penalty path"):
        G.penalty_path(table(spark), ["p_win"], ["a"], {"OLS": [1]})


def test_awkward(spark):
    df = table(spark)
    m = G.moments(df.selectExpr("nullif(a, a) as a", "b", "0.25D as c", "p_win"), ["a", "b", "c", "p_win"])
    with pytest.raises(ValueError, match="'a' has 90 missing"):
        G.least_squares(m, "p_win", ["a", "b"])
    assert G.least_squares(m, "p_win", ["b", "c"]).betas["c"] == pytest.approx(0)  # a constant column
    assert G.lasso_fit(m, "p_win", ["b", "c"], 0.0).betas["c"] == 0
    assert G.no_intercept(m, "p_win", ["a", "b"]).betas["a"] == pytest.approx(0)
    twice = df.withColumn("d", df["b"])
    t = G.moments(twice, ["b", "d", "p_win"])
    both = G.least_squares(t, "p_win", ["b", "d"])
    one = G.least_squares(t, "p_win", ["b"])
    assert both.betas["b"] + both.betas["d"] == pytest.approx(one.betas["b"]) and both.r2 == pytest.approx(one.r2)
    with pytest.raises(ValueError, match="no rows"):
        G.least_squares(G.moments(df.limit(0), ["a", "p_win"]), "p_win", ["a"])
