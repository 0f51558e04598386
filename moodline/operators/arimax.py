"""ARIMA(1,1,1) with regressors by maximum likelihood, for many series at a time.

The level is a regression with errors that are integrated once: differences obey
``dy = dx b + w``, ``w = phi w[-1] + e + theta e[-1]``. As a state space (the next value's forecast and the
last shock) the differences have an exact Gaussian likelihood by the Kalman filter, started from the
stationary distribution. The filter is linear in the data, so it runs over the label and the regressors
alike; coefficients and variance then have closed forms, and only ``phi`` and ``theta`` are searched: on
a grid over the square of stationary, invertible values, refined around the best.

Spark deals out whole series; a task fits those of one length side by side, some hundred at a time. A series
has a row per time, so its length is bounded by the calendar, not by the rows that were rolled up into it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Code of this module travels to the Python workers with the job, so they need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EDGE = 0.99  # of phi and theta
GRID = 17  # values of each at first
ROUNDS = 14  # refinements, each on a third of the width before
LEAST = 4  # rows of a series beyond its regressors
CELLS = 1 << 20  # values that the filters of series side by side hold at once, about
SIDE = 256  # series that a task reads before it fits them


@dataclass(frozen=True)
class Arimax:
    phi: float
    theta: float
    betas: np.ndarray
    sigma2: float
    loglik: float
    n: int  # differences


def filtered(data: np.ndarray, phi: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kalman filter of columns of ``data`` (time, column) for many (phi, theta) side by side.

    Innovations (time, parameter, column), and their variances in units of the shocks' (time, parameter).
    Series side by side have an axis more: data (time, series, 1, column), (phi, theta) by series and parameter.
    """
    n, k = data.shape[0], data.shape[-1]
    out, variance = np.empty((n, *phi.shape, k)), np.empty((n, *phi.shape))
    f = (1 + 2 * phi * theta + theta**2) / (1 - phi**2)  # of a stationary value
    square = theta**2
    for t in range(n):
        variance[t] = f
        f = 1 + square - square / f
    gain = theta / variance
    forecast = np.zeros((*phi.shape, k))
    slope = phi[..., None]
    for t in range(n):
        np.subtract(data[t], forecast, out=out[t])
        np.multiply(gain[t][..., None], out[t], out=forecast)
        forecast += slope * data[t]
    return out, variance


def likelihoods(dy: np.ndarray, dx: np.ndarray, phi: np.ndarray, theta: np.ndarray):
    """Log-likelihood, coefficients and variance of the best regression for each (phi, theta).

    ``dy`` and ``dx`` are one series, (time) and (time, column), or have an axis of series before these.
    """
    data = np.concatenate((dy[..., None], dx), axis=-1)
    n = data.shape[-2]
    if data.ndim == 3:
        data = data.transpose(1, 0, 2)[:, :, None, :]
    v, f = filtered(data, phi, theta)
    root = np.sqrt(f)
    y, x = v[..., 0] / root, v[..., 1:] / root[..., None]
    if x.shape[-1] == 1:
        one = x[..., 0]
        square = (one**2).sum(axis=0)
        b = np.divide((one * y).sum(axis=0), square, out=np.zeros_like(square), where=square > 0)[..., None]
        y = y - one * b[..., 0]
    elif x.shape[-1]:
        x = np.moveaxis(x, 0, -2)
        across = np.swapaxes(x, -1, -2)
        # of coefficients that fit alike the smallest
        moments = across @ np.moveaxis(y, 0, -1)[..., None]
        b = (np.linalg.pinv(across @ x, rcond=1e-12, hermitian=True) @ moments)[..., 0]
        y = y - np.moveaxis((x @ b[..., None])[..., 0], -1, 0)
    else:
        b = np.zeros((*phi.shape, 0))
    sigma2 = np.maximum((y**2).sum(axis=0) / n, 1e-300)
    return -n / 2 * (np.log(2 * np.pi * sigma2) + 1) - np.log(f).sum(axis=0) / 2, b, sigma2


def _searched(dy: np.ndarray, dx: np.ndarray) -> list[Arimax]:
    """Fits of series of one length, differences (series, time) and (series, time, column)."""
    many, n = dy.shape
    at = np.arange(many)
    center, width, size = np.zeros((many, 2)), EDGE, GRID
    best = np.full(many, -np.inf)
    found = [np.zeros(many), np.zeros(many), np.zeros((many, dx.shape[2])), np.full(many, np.nan)]
    for turn in range(ROUNDS + 1):
        axes = np.clip(np.linspace(center - width, center + width, size, axis=-1), -EDGE, EDGE)
        phi = np.broadcast_to(axes[:, 0, :, None], (many, size, size)).reshape(many, -1)
        theta = np.broadcast_to(axes[:, 1, None, :], (many, size, size)).reshape(many, -1)
        value, b, sigma2 = likelihoods(dy, dx, phi, theta)
        top = np.argmax(value, axis=1)
        better = value[at, top] > best if turn else np.ones(many, bool)
        best = np.where(better, value[at, top], best)
        for held, new in zip(found, (phi, theta, b, sigma2), strict=True):
            held[better] = new[at, top][better]
        center, width, size = np.column_stack(found[:2]), width / 3, 5
    phi, theta, b, sigma2 = found
    return [Arimax(float(phi[i]), float(theta[i]), b[i], float(sigma2[i]), float(best[i]), n) for i in range(many)]


def fit_many(series: Sequence[tuple[np.ndarray, np.ndarray]]) -> list[Arimax | None]:
    """Fits of series (label, regressors), each in order of time; None for those too short.

    Series of one length are fitted side by side, as many as a bounded array holds.
    """
    out: list[Arimax | None] = [None] * len(series)
    alike: dict[int, list[int]] = {}
    moves = [(np.diff(y), np.diff(x, axis=0)) for y, x in series]
    for place, (dy, dx) in enumerate(moves):
        if len(dy) < dx.shape[1] + LEAST:
            continue
        if np.ptp(dy) == 0 and not dx.any():
            out[place] = Arimax(0.0, 0.0, np.zeros(dx.shape[1]), float((dy**2).mean()), np.nan, len(dy))
        else:
            alike.setdefault(len(dy), []).append(place)
    for n, places in alike.items():
        step = max(1, CELLS // (GRID**2 * n * (1 + moves[places[0]][1].shape[1])))
        for first in range(0, len(places), step):
            some = places[first : first + step]
            fits = _searched(np.stack([moves[p][0] for p in some]), np.stack([moves[p][1] for p in some]))
            for place, fit in zip(some, fits, strict=True):
                out[place] = fit
    return out


def fit_values(y: np.ndarray, x: np.ndarray) -> Arimax | None:
    """Fit of one series, in order of time; None if it is too short."""
    return fit_many([(y, x)])[0]


def predict_values(y: np.ndarray, x: np.ndarray, model: Arimax, ahead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One-step predictions of the known levels (the first has none), and forecasts for further regressors."""
    dy, dx = np.diff(y), np.diff(x, axis=0)
    w = dy - dx @ model.betas
    phi, theta = np.array([model.phi]), np.array([model.theta])
    v, f = filtered(w[:, None], phi, theta)
    inside = np.r_[np.nan, y[1:] - v[:, 0, 0]]
    forecast = model.phi * w[-1] + model.theta * v[-1, 0, 0] / f[-1, 0]
    level, last, out = y[-1], x[-1], []
    for row in ahead:
        level = level + (row - last) @ model.betas + forecast
        out.append(level)
        last, forecast = row, model.phi * forecast
    return inside, np.array(out)


def _parts(y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows of a series in order of time: known ones, and those to forecast after them."""
    whole = np.isfinite(x).all(axis=1) if x.shape[1] else np.ones(len(x), bool)
    known = whole & np.isfinite(y)
    after = whole & (np.arange(len(y)) > (np.flatnonzero(known)[-1] if known.any() else -1)) & ~known
    return known, after


FIRST, VALUE = "_first_of_series", "_value_"


def _dealt(df: DataFrame, series: Sequence[str], label: str, features: Sequence[str], order_by: str) -> DataFrame:
    """The rows, whole series in order of time, with FIRST and the label and features as doubles.

    Series over as many tasks as a shuffle has: their rows are few for the work they make, so they
    must not be put together again by size.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_time = Window.partitionBy(*[F.col(f"`{c}`") for c in series]).orderBy(F.col(f"`{order_by}`").asc_nulls_last())
    values = [F.col(f"`{c}`").cast("double").alias(f"{VALUE}{i}") for i, c in enumerate([label, *features])]
    dealt = df.repartition(tasks, *[F.col(f"`{c}`") for c in series])
    return dealt.select("*", *values, (F.row_number().over(in_time) == 1).alias(FIRST))


def _fitted(batches: Iterator[pa.RecordBatch], inputs: int):
    """Tables of whole series: the table, where each begins, and of each its label, regressors and fit."""

    def done(held: list[pa.RecordBatch]):
        table = pa.Table.from_batches(held)
        starts = np.flatnonzero(table.column(FIRST).to_numpy())
        values = [table.column(f"{VALUE}{i}").to_numpy().astype(float) for i in range(inputs)]
        ends = np.append(starts[1:], table.num_rows)
        x = np.column_stack(values[1:]) if inputs > 1 else np.zeros((table.num_rows, 0))
        parts = [(values[0][i:j], x[i:j]) for i, j in zip(starts, ends, strict=True)]
        known = [_parts(*p)[0] for p in parts]
        return table, starts, parts, fit_many([(y[k], x[k]) for (y, x), k in zip(parts, known, strict=True)])

    held, count = [], 0
    for batch in batches:
        starts = np.flatnonzero(batch.column(FIRST).to_numpy(zero_copy_only=False))
        if len(starts) and count + len(starts) > SIDE and (held or starts[-1]):
            yield done([*held, batch.slice(0, starts[-1])])
            held, count = [batch.slice(starts[-1])], 1
        elif batch.num_rows:
            held.append(batch)
            count += len(starts)
    if held:
        yield done(held)


def fit_series(
    df: DataFrame, series: Sequence[str], label: str, features: Sequence[str], order_by: str = "date"
) -> DataFrame:
    """A row per series: its keys, n, phi, theta, sigma2, loglik and the coefficients ``beta_<feature>``.

    Rows with a missing label or regressor are left out, and the others follow one another. A series too
    short for its regressors has nulls. Of rows at the same time any may come first: there should be one.
    """
    schema = T.StructType([df.schema[c] for c in series]).add("n", "long")
    for name in ("phi", "theta", "sigma2", "loglik", *[f"beta_{f}" for f in features]):
        schema = schema.add(name, "double")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts, parts, models in _fitted(batches, 1 + len(features)):
            rows = []
            for (y, x), m in zip(parts, models, strict=True):
                if m is None:
                    rows.append([max(int(_parts(y, x)[0].sum()) - 1, 0), *[None] * (4 + len(features))])
                else:
                    rows.append([m.n, m.phi, m.theta, m.sigma2, m.loglik, *map(float, m.betas)])
            own = [pa.array(c, pa.int64() if i == 0 else pa.float64()) for i, c in enumerate(zip(*rows, strict=True))]
            keys = table.select(list(series)).take(pa.array(starts))
            yield from pa.Table.from_arrays([*keys.columns, *own], names=schema.names).to_batches()

    columns = dict.fromkeys([*series, order_by, label, *features])
    return _dealt(df.select(*columns), series, label, features, order_by).mapInArrow(fit, schema)


def predict_series(
    df: DataFrame,
    series: Sequence[str],
    label: str,
    features: Sequence[str],
    order_by: str = "date",
    column: str = "prediction",
) -> DataFrame:
    """The rows with one-step predictions, and forecasts for rows behind the last known label.

    No prediction: the first row of a series, rows with missing values, and series too short to fit.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(column, T.DoubleType())])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _, parts, models in _fitted(batches, 1 + len(features)):
            found = []
            for (y, x), model in zip(parts, models, strict=True):
                out = np.full(len(y), np.nan)
                if model is not None:
                    known, after = _parts(y, x)
                    out[known], out[after] = predict_values(y[known], x[known], model, x[after])
                found.append(out)
            out = np.concatenate(found)
            own = pa.array(out, pa.float64(), mask=~np.isfinite(out))
            rows = table.select(schema.names[:-1])
            yield from pa.Table.from_arrays([*rows.columns, own], names=schema.names).to_batches()

    return _dealt(df, series, label, features, order_by).mapInArrow(predict, schema)
