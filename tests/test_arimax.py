"""The filter against the Gaussian density, the fit against others, series side by side."""

import datetime as dt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from moodline.operators import arimax as A
from moodline.operators import models as M


def covariance(n, phi, theta):
    """Of an ARMA(1,1) with shocks of variance 1."""
    g = np.zeros(n)
    g[0] = (1 + 2 * phi * theta + theta**2) / (1 - phi**2)
    if n > 1:
        g[1:] = (1 + phi * theta) * (phi + theta) / (1 - phi**2) * phi ** np.arange(n - 1)
    return g[np.abs(np.subtract.outer(range(n), range(n)))]


def simulated(n=150, phi=0.6, theta=0.3, beta=(0.8,), seed=1):
    draw = np.random.default_rng(seed)
    e = draw.normal(size=n + 50) * 0.1
    w = np.zeros(n + 50)
    for t in range(1, n + 50):
        w[t] = phi * w[t - 1] + e[t] + theta * e[t - 1]
    x = draw.normal(size=(n, len(beta))).cumsum(axis=0)
    return x @ beta + w[50:].cumsum(), x


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.floats(-0.95, 0.95), st.floats(-0.95, 0.95), st.integers(0, 2), st.integers(0, 99))
def test_filter_is_the_gaussian_density(n, phi, theta, k, seed):
    draw = np.random.default_rng(seed)
    dy, dx = draw.normal(size=n + k + 1), draw.normal(size=(n + k + 1, k))
    (value,), (b,), (sigma2,) = A.likelihoods(dy, dx, np.array([phi]), np.array([theta]))
    c = covariance(len(dy), phi, theta)
    inverse = np.linalg.inv(c)
    want = np.linalg.solve(dx.T @ inverse @ dx, dx.T @ inverse @ dy) if k else np.zeros(0)
    r = dy - dx @ want
    s = r @ inverse @ r / len(dy)
    density = -0.5 * (len(dy) * np.log(2 * np.pi * s) + np.linalg.slogdet(c)[1] + len(dy))
    assert np.allclose(b, want, atol=1e-6) and np.isclose(sigma2, s) and np.isclose(value, density)


def test_finds_the_maximum():
    y, x = simulated(400)
    found = A.fit_values(y, x)
    assert abs(found.phi - 0.6) < 0.15 and abs(found.theta - 0.3) < 0.2 and abs(found.betas[0] - 0.8) < 0.05
    near = np.array([-1e-3, 0, 1e-3])
    phi, theta = (g.ravel() for g in np.meshgrid(found.phi + near, found.theta + near))
    assert A.likelihoods(np.diff(y), np.diff(x, axis=0), phi, theta)[0].max() <= found.loglik + 1e-6
    fine = np.linspace(-0.99, 0.99, 67)
    phi, theta = (g.ravel() for g in np.meshgrid(fine, fine))
    assert A.likelihoods(np.diff(y), np.diff(x, axis=0), phi, theta)[0].max() <= found.loglik


def rows_of(key, y, x):
    day = dt.date(2024, 1, 1)
    return [(key, day + dt.timedelta(days=i), *map(float, r), None if v is None else float(v)) for i, (v, r) in enumerate(zip(y, x, strict=True))]


def test_not_below_two_regressions(spark):
    for seed in (1, 2, 3):
        y, x = simulated(120, seed=seed)
        df = spark.createDataFrame(rows_of("s", y, x), "key string, date date, a double, p_win double")
        two = M.fit_arimax(df, "p_win", ["a"])
        dy, dx = np.diff(y), np.diff(x, axis=0)
        phi, theta = np.clip([two.betas["ar1"], two.betas["ma1"]], -0.99, 0.99)
        (other,), _, _ = A.likelihoods(dy - dx @ [two.betas["a"]], dx[:, :0], np.array([phi]), np.array([theta]))
        assert A.fit_values(y, x).loglik >= other
        fit = M.fit_model(df.drop("key"), "SARIMAX", method="likelihood")
        assert fit.betas["a"] == pytest.approx(A.fit_values(y, x).betas[0]) and fit.predictions.columns[-1] == "prediction"


def test_series_side_by_side(spark):
    series = {k: simulated(40 + k, seed=k) for k in range(4)}
    rows = [r for k, (y, x) in series.items() for r in rows_of(k, y, x)]
    rows += rows_of(9, [1.0, 2.0, 3.0], [[0.0]] * 3) + rows_of(8, [None] * 30, [[0.0]] * 30) + rows_of(7, [0.5] * 30, [[1.0]] * 30)
    df = spark.createDataFrame(rows, "key int, date date, a double, y double").repartition(5)
    got = {r.key: r for r in A.fit_series(df, ["key"], "y", ["a"]).collect()}
    for k, (y, x) in series.items():
        want = A.fit_values(y, x)
        assert got[k].n == len(y) - 1 and got[k].loglik == pytest.approx(want.loglik)
        assert [got[k].phi, got[k].theta, got[k].beta_a] == pytest.approx([want.phi, want.theta, want.betas[0]])
    assert got[9].n == 2 and got[9].phi is None and got[8].n == 0 and got[7].sigma2 == 0
    assert A.fit_series(df.limit(0), ["key"], "y", ["a"]).collect() == []


def test_forecasts(spark):
    y, x = simulated(80)
    known = [*y[:70], *[None] * 10]
    df = spark.createDataFrame(rows_of(1, known, x), "key int, date date, a double, y double")
    got = [r.prediction for r in A.predict_series(df, ["key"], "y", ["a"]).orderBy("date").collect()]
    model = A.fit_values(y[:70], x[:70])
    # by the joint distribution of all differences
    c = covariance(79, model.phi, model.theta)
    w = np.diff(y[:70]) - np.diff(x[:70], axis=0) @ model.betas
    ahead = c[69:, :69] @ np.linalg.solve(c[:69, :69], w)
    want = y[69] + np.cumsum(ahead + np.diff(x[69:], axis=0) @ model.betas)
    assert got[0] is None and np.allclose(got[70:], want, atol=1e-8)
    one = [np.r_[c[t, :t] @ np.linalg.solve(c[:t, :t], w[:t])][0] if t else 0.0 for t in range(69)]
    assert np.allclose(got[1:70], y[:69] + np.diff(x[:70], axis=0) @ model.betas + one, atol=1e-8)


def test_series_of_one_length_are_filtered_together(spark, monkeypatch):
    calls = []
    filtered = A.filtered
    monkeypatch.setattr(A, "filtered", lambda *a: (calls.append(1), filtered(*a))[1])
    series = [simulated(30 + k % 2, seed=k) for k in range(24)]
    alone = [A.fit_values(*s) for s in series]
    one_by_one = len(calls)
    side_by_side = A.fit_many(series)
    assert (len(calls) - one_by_one) * 6 <= one_by_one
    for a, b in zip(alone, side_by_side, strict=True):
        assert [a.loglik, a.phi, a.theta, *a.betas] == pytest.approx([b.loglik, b.phi, b.theta, *b.betas], abs=1e-5)
    monkeypatch.setattr(A, "filtered", filtered)
    monkeypatch.setattr(A, "SIDE", 3)  # series that cross what a task reads at once
    rows = [r for k, (y, x) in enumerate(series) for r in rows_of(k, y, x)] + rows_of(None, *simulated(50, seed=77))
    df = spark.createDataFrame(rows, "key int, date date, a double, y double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r.key: r for r in A.fit_series(df, ["key"], "y", ["a"]).collect()}
        assert A.predict_series(df, ["key"], "y", ["a"]).filter("prediction is not null").count() == len(rows) - 25
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    assert len(got) == 25 and got[None].n == 49
    assert all(got[k].loglik == pytest.approx(m.loglik) and got[k].n == m.n for k, m in enumerate(alone))
