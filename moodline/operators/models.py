"""Regressions of the daily probability on the daily features, by Spark ML.

Only coefficients and a few scalars reach the driver. A fit passes over its input
several times: hand in a stored table (``session.stage``), not a plan that starts at
the raw texts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodline.operators import arimax, boosting
from moodline.operators.moments import INTERCEPT

PREDICTION = "prediction"
TREES = 100
LABEL_COLUMNS = ("p_win", "p_lose", "p_win_rolling")


@dataclass(frozen=True)
class Fit:
    """A fitted model: its in-sample predictions and, if linear, its coefficients."""

    name: str
    label: str
    features: tuple[str, ...]
    predictions: DataFrame  # the input rows + prediction
    betas: dict[str, float] = field(default_factory=dict)
    r2: float | None = None

    def params(self) -> DataFrame:
        """(feature, beta)."""
        rows = [(name, float(beta)) for name, beta in self.betas.items()]
        return self.predictions.sparkSession.createDataFrame(rows, "feature string, beta double")


def feature_columns(df: DataFrame, label: str, ignore: Sequence[str] = ("date",)) -> list[str]:
    """All columns but the day and every label column, rolled or not."""
    left_out = {label, *LABEL_COLUMNS, *ignore}
    return [c for c in df.columns if c not in left_out]


def _assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(
        inputCols=list(features), outputCol="_features", handleInvalid="error"
    ).transform(df)


def _linear(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    name: str,
    *,
    intercept: bool = True,
    l1: float = 0.0,
    l2: float = 0.0,
) -> Fit:
    data = _assemble(df, features)
    model = LinearRegression(
        featuresCol="_features",
        labelCol=label,
        predictionCol=PREDICTION,
        fitIntercept=intercept,
        regParam=l1 or l2,
        elasticNetParam=1.0 if l1 else 0.0,
        standardization=False,
        solver="normal",
        maxIter=1000,
        tol=1e-10,
    ).fit(data)
    betas = dict(zip(features, model.coefficients, strict=True))
    if intercept:
        betas[INTERCEPT] = model.intercept
    return Fit(
        name,
        label,
        tuple(features),
        model.transform(data).drop("_features"),
        {k: float(v) for k, v in betas.items()},
        float(model.summary.r2),
    )


def fit_ols_no_intercept(df: DataFrame, label: str, features: Sequence[str]) -> Fit:
    """Least squares through the origin; missing values count as 0; R² is uncentred."""
    filled = df.fillna(0.0, subset=[label, *features])
    return _linear(filled, label, features, "ols_no_intercept", intercept=False)


def fit_linear(df: DataFrame, label: str, features: Sequence[str]) -> Fit:
    return _linear(df, label, features, "linear")


def fit_ridge(df: DataFrame, label: str, features: Sequence[str], alpha: float = 1.0) -> Fit:
    """Minimise ``|y - Xw|² + alpha |w|²``.

    Spark's penalty is per row and on a label scaled to unit deviation, hence the
    factor. A constant label has no deviation and needs no penalty: w = 0.
    """
    stats = df.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("sd")).first()
    strength = alpha / stats["n"] * stats["sd"] if stats["n"] else 0.0
    return _linear(df, label, features, "ridge", l2=strength)


def fit_lasso(df: DataFrame, label: str, features: Sequence[str], alpha: float = 1.0) -> Fit:
    """Minimise ``|y - Xw|² / 2n + alpha |w|``."""
    return _linear(df, label, features, "lasso", l1=alpha)


def fit_trees(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    n_estimators: int = TREES,
    max_depth: int = 3,
    step: float = 0.1,
    bins: int = boosting.BINS,
) -> boosting.Boosted:
    return boosting.fit(df, label, features, n_estimators, max_depth, step, bins)


def fit_boosting(df: DataFrame, label: str, features: Sequence[str], **options) -> Fit:
    """Gradient-boosted trees on the squared error; options are those of ``fit_trees``."""
    model = fit_trees(df, label, features, **options)
    return Fit("boosting", label, tuple(features), df.withColumn(PREDICTION, boosting.prediction(features, model)))


def fit_arimax(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    *,
    order_by: str = "date",
    series: Sequence[str] = (),
    long_lags: int = 4,
) -> Fit:
    """ARIMA(1,1,1) with regressors by two regressions (Hannan & Rissanen, 1982).

    On first differences: a long autoregression gives residuals, which then stand in
    for the unseen shocks in ``dy = b dx + phi dy[-1] + theta e[-1]``. Rows too early
    to have all lags get no prediction. Lags are taken within ``series``; without it
    the table is one daily series.
    """
    w = Window.partitionBy(*series).orderBy(order_by)
    d_label, shock = "_dy", "_shock"
    d_features = [f"_d_{c}" for c in features]
    diffs = df.withColumns(
        {
            d_label: F.col(label) - F.lag(label).over(w),
            **{
                d: F.col(c) - F.lag(c).over(w) for c, d in zip(features, d_features, strict=True)
            },
        }
    )
    lags = [f"_lag{k}" for k in range(1, long_lags + 1)]
    lagged = diffs.withColumns(
        {name: F.lag(d_label, k).over(w) for k, name in enumerate(lags, start=1)}
    )
    long_rows = lagged.dropna(subset=[d_label, *d_features, *lags])
    long_fit = _linear(long_rows, d_label, [*d_features, *lags], "long", intercept=False)
    shocks = long_fit.predictions.withColumn(shock, F.col(d_label) - F.col(PREDICTION)).drop(
        PREDICTION
    )
    with_shock = shocks.withColumn("_shock1", F.lag(shock).over(w))
    short_rows = with_shock.dropna(subset=["_shock1"])
    fit = _linear(
        short_rows, d_label, [*d_features, lags[0], "_shock1"], "arimax", intercept=False
    )
    names = [*features, "ar1", "ma1"]
    level = fit.predictions.withColumn(
        PREDICTION, F.col(label) - F.col(d_label) + F.col(PREDICTION)
    ).select(*df.columns, PREDICTION)
    return Fit(
        "arimax",
        label,
        tuple(features),
        level,
        dict(zip(names, fit.betas.values(), strict=True)),
    )


def fit_arimax_likelihood(
    df: DataFrame, label: str, features: Sequence[str], *, order_by: str = "date"
) -> Fit:
    """ARIMA(1,1,1) with regressors by likelihood; the table is one series with a row per ``order_by``."""
    series = df.withColumn("_series", F.lit(0))
    row = arimax.fit_series(series, ["_series"], label, features, order_by).first()
    if row is None or row["phi"] is None:
        raise ValueError("a series too short for its regressors")
    betas = {f: row[f"beta_{f}"] for f in features} | {"ar1": row["phi"], "ma1": row["theta"]}
    predictions = arimax.predict_series(series, ["_series"], label, features, order_by, PREDICTION)
    return Fit("arimax", label, tuple(features), predictions.drop("_series"), betas)


ARIMAX_METHODS: dict[str, Callable[..., Fit]] = {
    "regressions": fit_arimax,
    "likelihood": fit_arimax_likelihood,
}


def fit_sarimax(
    df: DataFrame, label: str, features: Sequence[str], *, method: str = "regressions", **options
) -> Fit:
    """ARIMA(1,1,1) with regressors, by two regressions or by likelihood."""
    if method not in ARIMAX_METHODS:
        raise ValueError(f"unknown method: {method!r}")
    return ARIMAX_METHODS[method](df, label, features, **options)


# The model names a run may ask for.
MODELS: dict[str, Callable[..., Fit]] = {
    "OLS no intercept": fit_ols_no_intercept,
    "OLS": fit_linear,
    "Linear Regression": fit_linear,
    "Ridge": fit_ridge,
    "Lasso": fit_lasso,
    "Gradient Boosting": fit_boosting,
    "SARIMAX": fit_sarimax,
}


def target_of(rolling: bool, label: str = "p_win") -> str:
    """The column a model explains."""
    return f"{label}_rolling" if rolling else label


def fit_model(
    df: DataFrame, name: str, *, label: str = "p_win", rolling: bool = False, **options
) -> Fit:
    """Fit by name on every feature column; ``rolling`` targets the trailing mean."""
    if name not in MODELS:
        raise ValueError(f"unknown model: {name!r}")
    target = target_of(rolling, label)
    return MODELS[name](df, target, feature_columns(df, target), **options)
