"""Least squares, ridge and lasso from one pass: counts, means and cross products of all columns.

One aggregation over the rows gives the moments of every feature and every label. All that a linear fit
needs is in them, so any choice of label, features, model and penalty is solved on the driver without
another job; the matrices have a row per column of the table, however many rows it has. Least squares
and ridge are solved directly, the lasso by coordinate descent on the covariances.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INTERCEPT = "intercept"


@dataclass(frozen=True)
class Moments:
    """Of complete rows: count, means, covariances; and mean products with missing values as 0."""

    columns: tuple[str, ...]
    n: int
    present: np.ndarray  # values that aren't null, by column
    mean: np.ndarray
    cov: np.ndarray  # population covariances
    origin: np.ndarray  # mean products about 0

    def at(self, names: Sequence[str]) -> list[int]:
        return [self.columns.index(c) for c in names]

    def complete(self, names: Sequence[str]) -> None:
        """Raises if a column has missing values, or there is no row."""
        if not self.n:
            raise ValueError("no rows to fit on")
        for name, i in zip(names, self.at(names), strict=True):
            if self.present[i] != self.n:
                raise ValueError(f"column {name!r} has {self.n - self.present[i]} missing values")


def moments(df: DataFrame, columns: Sequence[str]) -> Moments:
    """Moments of numeric columns, from one aggregation."""
    k = len(columns)
    value = [F.col(f"`{c}`").cast("double") for c in columns]
    # NaN is a missing value like null
    value = [F.when(~F.isnan(v), v) for v in value]
    filled = [F.coalesce(v, F.lit(0.0)) for v in value]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = df.agg(
        F.count(F.lit(1)),
        *[F.count(v) for v in value],
        *[F.avg(v) for v in value],
        *[F.covar_pop(value[i], value[j]) for i, j in pairs],
        *[F.avg(filled[i] * filled[j]) for i, j in pairs],
    ).first()
    numbers = np.array([0.0 if v is None else v for v in row[1:]], float)
    present, mean = numbers[:k].astype(int), numbers[k : 2 * k]
    cov, origin = np.zeros((k, k)), np.zeros((k, k))
    for place, (i, j) in enumerate(pairs):
        cov[i, j] = cov[j, i] = numbers[2 * k + place]
        origin[i, j] = origin[j, i] = numbers[2 * k + len(pairs) + place]
    return Moments(tuple(columns), row[0], present, mean, cov, origin)


def solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The solution, of several the shortest one (features that depend on each other)."""
    return np.linalg.lstsq(a, b, rcond=1e-12)[0]


def lasso(cov: np.ndarray, target: np.ndarray, alpha: float, start: np.ndarray | None = None) -> np.ndarray:
    """Minimise ``w' cov w / 2 - w' target + alpha |w|`` by coordinate descent.

    Stops when no coefficient can gain more than rounding; each step solves its coefficient exactly.
    """
    w = np.zeros(len(target)) if start is None else start.copy()
    scale = np.abs(target).max(initial=0.0) + alpha
    for _ in range(100_000):
        most = 0.0
        for j in range(len(w)):
            if cov[j, j] <= 0:
                w[j] = 0.0  # a constant column
                continue
            rest = target[j] - cov[j] @ w + cov[j, j] * w[j]
            new = np.sign(rest) * max(abs(rest) - alpha, 0.0) / cov[j, j]
            most = max(most, abs(new - w[j]) * cov[j, j])
            w[j] = new
        if most <= 1e-15 * scale:
            break
    return w


@dataclass(frozen=True)
class Solution:
    betas: dict[str, float]
    r2: float

    def column(self):
        """The prediction."""
        out = F.lit(self.betas.get(INTERCEPT, 0.0))
        for name, beta in self.betas.items():
            if name != INTERCEPT:
                # without an intercept missing values count as 0
                value = F.col(f"`{name}`").cast("double")
                out = out + F.lit(beta) * (value if INTERCEPT in self.betas else F.coalesce(value, F.lit(0.0)))
        return out


def _solved(m: Moments, label: str, features: Sequence[str], w: np.ndarray) -> Solution:
    """Coefficients with the intercept, and R² about the mean."""
    x, (y,) = m.at(features), m.at([label])
    constant = float(m.mean[y] - m.mean[x] @ w)
    left = m.cov[y, y] - 2 * w @ m.cov[x, y] + w @ m.cov[np.ix_(x, x)] @ w
    r2 = 1 - left / m.cov[y, y] if m.cov[y, y] > 0 else 1.0 if left <= 1e-30 else 0.0
    return Solution({**dict(zip(features, map(float, w), strict=True)), INTERCEPT: constant}, float(r2))


def no_intercept(m: Moments, label: str, features: Sequence[str]) -> Solution:
    """Least squares through the origin; missing values count as 0; R² is uncentred."""
    if not m.n:
        raise ValueError("no rows to fit on")
    x, (y,) = m.at(features), m.at([label])
    w = solve(m.origin[np.ix_(x, x)], m.origin[x, y])
    left = m.origin[y, y] - 2 * w @ m.origin[x, y] + w @ m.origin[np.ix_(x, x)] @ w
    r2 = 1 - left / m.origin[y, y] if m.origin[y, y] > 0 else 0.0
    return Solution(dict(zip(features, map(float, w), strict=True)), float(r2))


def ridge(m: Moments, label: str, features: Sequence[str], alpha: float = 1.0) -> Solution:
    """Minimise ``|y - Xw|² + alpha |w|²``; least squares for ``alpha`` 0."""
    m.complete([label, *features])
    x, (y,) = m.at(features), m.at([label])
    w = solve(m.cov[np.ix_(x, x)] + alpha / m.n * np.eye(len(x)), m.cov[x, y])
    return _solved(m, label, features, w)


def least_squares(m: Moments, label: str, features: Sequence[str]) -> Solution:
    return ridge(m, label, features, 0.0)


def lasso_fit(m: Moments, label: str, features: Sequence[str], alpha: float = 1.0, start=None) -> Solution:
    """Minimise ``|y - Xw|² / 2n + alpha |w|``."""
    m.complete([label, *features])
    x, (y,) = m.at(features), m.at([label])
    return _solved(m, label, features, lasso(m.cov[np.ix_(x, x)], m.cov[x, y], alpha, start))


# Names of the models that moments are enough for.
FROM_MOMENTS = {
    "OLS no intercept": no_intercept,
    "OLS": least_squares,
    "Linear Regression": least_squares,
    "Ridge": ridge,
    "Lasso": lasso_fit,
}


def penalty_path(
    df: DataFrame, labels: Sequence[str], features: Sequence[str], penalties: Mapping[str, Sequence[float]]
) -> DataFrame:
    """(label, model, alpha, feature, beta, r2): fits for every label, model and penalty, from one pass.

    ``penalties`` maps "Ridge" and "Lasso" to their alphas. A lasso starts from the fit of the next
    larger penalty, where fewer coefficients move.
    """
    unknown = set(penalties) - {"Ridge", "Lasso"}
    if unknown:
        raise ValueError(f"no penalty path for {sorted(unknown)}")
    m = moments(df, [*dict.fromkeys([*features, *labels])])
    rows = []
    for label in labels:
        for model, alphas in penalties.items():
            start = None
            for alpha in sorted(set(map(float, alphas)), reverse=True):
                if model == "Ridge":
                    found = ridge(m, label, features, alpha)
                else:
                    found = lasso_fit(m, label, features, alpha, start)
                    start = np.array([found.betas[f] for f in features])
                rows += [(label, model, alpha, f, b, found.r2) for f, b in found.betas.items()]
    schema = "label string, model string, alpha double, feature string, beta double, r2 double"
    return df.sparkSession.createDataFrame(rows, schema)
