import datetime as dt

import numpy as np
import pytest

from moodline.operators import models as M

N = 80
RNG = np.random.default_rng(4)
X = RNG.normal(size=(N, 2)) * [1.0, 3.0] + [0.5, -1.0]
Y = X @ [0.3, -0.2] + 0.6 + RNG.normal(size=N) * 0.1


def table(spark, x=X, y=Y):
    day = dt.date(2024, 1, 1)
    rows = [(day + dt.timedelta(days=i), *map(float, x[i]), float(y[i])) for i in range(len(y))]
    return spark.createDataFrame(rows, "date date, a double, b double, p_win double")


def betas(fit):
    return np.array([fit.betas["a"], fit.betas["b"]])


def test_ols_no_intercept(spark):
    fit = M.fit_model(table(spark), "OLS no intercept")
    want = np.linalg.lstsq(X, Y, rcond=None)[0]
    assert betas(fit) == pytest.approx(want, abs=1e-9)
    assert M.INTERCEPT not in fit.betas
    assert fit.r2 == pytest.approx(1 - ((Y - X @ want) ** 2).sum() / (Y**2).sum(), abs=1e-9)


def test_ols_no_intercept_fills_gaps(spark):
    df = table(spark)
    gap = df.selectExpr("date", "nullif(a, a) AS a", "b", "p_win").limit(1).unionAll(df)
    x = np.vstack([[0.0, X[0, 1]], X])
    want = np.linalg.lstsq(x, np.append(Y[0], Y), rcond=None)[0]
    assert betas(M.fit_model(gap, "OLS no intercept")) == pytest.approx(want, abs=1e-9)
    with pytest.raises(Exception):
        M.fit_model(gap, "OLS")


def test_linear(spark):
    fit = M.fit_model(table(spark), "Linear Regression")
    want = np.linalg.lstsq(np.c_[X, np.ones(N)], Y, rcond=None)[0]
    assert [*betas(fit), fit.betas[M.INTERCEPT]] == pytest.approx(list(want), abs=1e-9)
    got = {r["feature"]: r["beta"] for r in fit.params().collect()}
    assert got == fit.betas


@pytest.mark.parametrize("alpha", [0.1, 5.0, 100.0])
def test_ridge(spark, alpha):
    fit = M.fit_model(table(spark), "Ridge", alpha=alpha)
    xc, yc = X - X.mean(0), Y - Y.mean()
    want = np.linalg.solve(xc.T @ xc + alpha * np.eye(2), xc.T @ yc)
    assert betas(fit) == pytest.approx(want, abs=1e-9)


def test_ridge_of_a_constant(spark):
    fit = M.fit_model(table(spark, y=np.full(N, 0.5)), "Ridge", alpha=1.0)
    assert betas(fit) == pytest.approx([0, 0], abs=1e-9)
    assert fit.betas[M.INTERCEPT] == pytest.approx(0.5)


@pytest.mark.parametrize("alpha", [0.01, 0.1, 10.0])
def test_lasso(spark, alpha):
    xc, yc = X - X.mean(0), Y - Y.mean()
    w = np.zeros(2)
    for _ in range(2000):
        for j in range(2):
            rho = xc[:, j] @ (yc - xc @ w + xc[:, j] * w[j]) / N
            w[j] = np.sign(rho) * max(abs(rho) - alpha, 0) / (xc[:, j] @ xc[:, j] / N)
    fit = M.fit_model(table(spark), "Lasso", alpha=alpha)
    assert betas(fit) == pytest.approx(w, abs=1e-5)


def test_boosting_learns(spark):
    fit = M.fit_model(table(spark), "Gradient Boosting", n_estimators=5, max_depth=2)
    rows = fit.predictions.collect()
    error = np.mean([(r["prediction"] - r["p_win"]) ** 2 for r in rows])
    assert len(rows) == N and error < np.var(Y) * 0.7


def test_arimax_is_two_regressions(spark):
    n = 120
    x = RNG.normal(size=(n, 2)).cumsum(0)
    e = RNG.normal(size=n) * 0.1
    dy = np.zeros(n)
    for t in range(1, n):
        dy[t] = (x[t] - x[t - 1]) @ [0.4, -0.1] + 0.5 * dy[t - 1] + e[t] + 0.3 * e[t - 1]
    y = dy.cumsum()
    dx, d = np.diff(x, axis=0), np.diff(y)
    t = np.arange(4, len(d))
    long = np.c_[dx[t], *[d[t - k] for k in (1, 2, 3, 4)]]
    shock = d[t] - long @ np.linalg.lstsq(long, d[t], rcond=None)[0]
    t2 = t[1:]
    short = np.c_[dx[t2], d[t2 - 1], shock[:-1]]
    want = np.linalg.lstsq(short, d[t2], rcond=None)[0]
    fit = M.fit_model(table(spark, x, y), "SARIMAX")
    assert list(fit.betas) == ["a", "b", "ar1", "ma1"]
    assert list(fit.betas.values()) == pytest.approx(list(want), abs=1e-6)
    rows = sorted(fit.predictions.collect(), key=lambda r: r["date"])
    assert len(rows) == len(t2)
    assert [r["prediction"] for r in rows] == pytest.approx(list(y[t2] + short @ want), abs=1e-6)


def test_arimax_of_many_series(spark):
    df = table(spark)
    both = df.selectExpr("'s' AS s", "*").unionAll(df.selectExpr("'t'", "*"))
    one = M.fit_arimax(df, "p_win", ["a", "b"])
    two = M.fit_arimax(both, "p_win", ["a", "b"], series=["s"])
    assert list(two.betas.values()) == pytest.approx(list(one.betas.values()), abs=1e-8)
    assert two.predictions.count() == 2 * one.predictions.count()


def test_no_label_among_the_features(spark):
    df = table(spark).selectExpr("*", "p_win AS p_win_rolling")
    assert M.feature_columns(df, "p_win") == ["a", "b"]
    assert M.fit_model(df, "OLS", rolling=True).label == "p_win_rolling"


def test_unknown_model(spark):
    with pytest.raises(ValueError):
        M.fit_model(table(spark), "Oracle")
