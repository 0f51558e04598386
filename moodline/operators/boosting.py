"""Least-squares gradient boosting on binned features.

Features are cut into bins, and rows of equal bins are one cell: a count and a sum of the label say all
that squared error needs, at every round, for such rows get the same prediction. So the rows are read
three times (range, bins, cells), whatever the number of trees. Each round takes sums by (node, feature,
bin) over the cells. Few cells, measured, come to the driver, which sums with numpy; many stay a
stored table, which Spark sums level by level.

Boosting starts at the mean. A node is split where the squared error falls most; of equal splits the
first feature's wins, then the lowest cut, so results don't depend on how the rows are dealt out. A leaf
moves its rows by ``step`` times the mean of what is left to explain.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.session import stage

# Code of this module travels to the Python workers with the job, so they need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 64  # of a feature, at most
FINE = 4096  # equal parts of a feature's range that bins are made of
CELLS = 1 << 18  # that the driver takes
TIE = 1e-10  # gains closer than this part of the root's error are equal


@dataclass
class Node:
    """A split, or a leaf if ``feature`` is -1. ``cut`` counts the bins that go left."""

    feature: int = -1
    cut: int = 0
    value: float = 0.0
    left: int = -1
    right: int = -1


@dataclass
class Boosted:
    start: float
    cuts: list[np.ndarray]  # rising thresholds by feature; a value up to one goes left
    trees: list[list[Node]] = field(default_factory=list)
    step: float = 0.1

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(self.cuts)], axis=1)

    def of_bins(self, bins: np.ndarray, trees: Sequence[list[Node]] | None = None) -> np.ndarray:
        out = np.zeros(len(bins))
        for tree in self.trees if trees is None else trees:
            out += self.step * np.array([n.value for n in tree])[leaves(tree, bins)]
        return out if trees is not None else out + self.start

    def first(self, trees: int) -> Boosted:
        """The model as it was after so many trees."""
        return Boosted(self.start, self.cuts, self.trees[:trees], self.step)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.of_bins(self.bins(x))


def leaves(tree: list[Node], bins: np.ndarray) -> np.ndarray:
    """The node each row of bins ends in."""
    at = np.zeros(len(bins), np.int64)
    for place, node in enumerate(tree):  # a node comes before those below it
        if node.feature >= 0:
            here = at == place
            at[here] = np.where(bins[here, node.feature] < node.cut, node.left, node.right)
    return at


def best_split(n: np.ndarray, s: np.ndarray, tie: float) -> tuple[int, int] | None:
    """Feature and cut with the greatest gain, from counts and sums by (feature, bin); None without a gain."""
    left_n, left_s = np.cumsum(n, axis=1)[:, :-1], np.cumsum(s, axis=1)[:, :-1]
    all_n, all_s = n[0].sum(), s[0].sum()
    right_n, right_s = all_n - left_n, all_s - left_s
    able = (left_n > 0) & (right_n > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left_s**2 / left_n + right_s**2 / right_n - all_s**2 / all_n
    gain = np.where(able, gain, -np.inf)
    if not gain.size or gain.max() <= tie:
        return None
    feature, cut = np.unravel_index(np.argmax(gain >= gain.max() - tie), gain.shape)  # the first of equals
    return int(feature), int(cut) + 1


#: (tree so far, open nodes) -> counts and sums of what is left, by (open node, feature, bin)
Sums = Callable[[list[Node], list[int]], tuple[np.ndarray, np.ndarray]]


def grow(sums: Sums, depth: int, tie: float) -> list[Node]:
    """One tree, level by level."""
    tree, open_ = [Node()], [0]
    for level in range(depth + 1):
        n, s = sums(tree, open_)
        following = []
        for place, node in enumerate(open_):
            total = n[place][0].sum()
            tree[node].value = float(s[place][0].sum() / total) if total else 0.0
            split = best_split(n[place], s[place], tie) if level < depth else None
            if split:
                tree[node].feature, tree[node].cut = split
                tree[node].left, tree[node].right = len(tree), len(tree) + 1
                following += [len(tree), len(tree) + 1]
                tree += [Node(), Node()]
        open_ = following
        if not open_:
            break
    return tree


def choose_cuts(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Thresholds of each feature, halfway between neighbouring values; all of them if the values are few.

    The range is cut into ``FINE`` equal parts first, so the driver gets that many rows for a feature at most.
    """
    ends = df.agg(*[e(f"`{f}`") for f in features for e in (F.min, F.max)]).first()
    parts = []
    for k, name in enumerate(features):
        low, high = float(ends[2 * k]), float(ends[2 * k + 1])
        x = F.col(f"`{name}`").cast("double")
        part = F.floor((x - low) / (high - low) * FINE) if high > low else F.lit(0).cast("long")
        parts.append(F.struct(F.lit(k).alias("feature"), F.least(part, F.lit(FINE - 1)).alias("part"), x.alias("x")))
    rows = (
        df.select(F.inline(F.array(*parts)))
        .groupBy("feature", "part")
        .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        .orderBy("feature", "part")
        .toPandas()
    )
    out = []
    for k in range(len(features)):
        own = rows[rows["feature"] == k]
        low, high, n = own["low"].to_numpy(), own["high"].to_numpy(), own["n"].to_numpy()
        between = (high[:-1] + low[1:]) / 2
        if len(own) > bins:  # about as many rows in each
            rank = np.cumsum(n)[:-1] * bins // n.sum()
            between = between[np.flatnonzero(np.diff(rank, prepend=0) > 0)]
        out.append(between)
    return out


def _bin(name: str, cuts: np.ndarray) -> Column:
    """A value's bin: the number of thresholds below it."""
    x = F.col(f"`{name}`").cast("double")
    return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]).cast("array<double>"), lambda c: x > c))


def fit(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    trees: int = 100,
    depth: int = 3,
    step: float = 0.1,
    bins: int = BINS,
    most_cells: int = CELLS,
) -> Boosted:
    """Fit on all rows. A missing value or an empty table is an error."""
    names = [label, *features]
    row = df.agg(F.count(F.lit(1)), *[F.count(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None))) for c in names]).first()
    if not row[0] or any(v != row[0] for v in row[1:]):
        raise ValueError("no rows to fit on" if not row[0] else "a feature or the label has missing values")
    cuts = choose_cuts(df, features, bins)
    place = [_bin(name, own).alias(f"b{k}") for k, (name, own) in enumerate(zip(features, cuts, strict=True))]
    keys = [f"b{k}" for k in range(len(features))]
    y = F.col(f"`{label}`").cast("double")
    cells = stage(
        df.select(*place, y.alias("y")).groupBy(*keys).agg(F.count("y").alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") ** 2).alias("q")),
        "boosting-cells",
    )
    n, s, q, size = cells.agg(F.sum("n"), F.sum("s"), F.sum("q"), F.count("n")).first()
    model = Boosted(s / n, cuts, step=step)
    tie = TIE * max(q - s * s / n, 0.0)
    widths = [len(c) + 1 for c in cuts]
    rounds = _on_driver(cells, keys, model, widths) if size <= most_cells else _on_spark(cells, keys, model, widths)
    for _ in range(trees):
        model.trees.append(grow(next(rounds), depth, tie))
    return model


def _on_driver(cells: DataFrame, keys: Sequence[str], model: Boosted, widths: Sequence[int]):
    """Sums of round after round from cells in memory."""
    # in order of the bins, so that sums don't depend on how the rows came
    frame = cells.orderBy(*keys).toPandas()
    place = frame[list(keys)].to_numpy(np.int64).reshape(len(frame), len(keys))
    n, left = frame["n"].to_numpy(float), frame["s"].to_numpy() - frame["n"].to_numpy() * model.start

    def sums(tree: list[Node], open_: list[int]) -> tuple[np.ndarray, np.ndarray]:
        at = leaves(tree, place)
        shape = (len(open_), len(keys), max(widths, default=1))
        counts, totals = np.zeros(shape), np.zeros(shape)
        for i, node in enumerate(open_):
            here = at == node
            for k, w in enumerate(widths):
                counts[i, k, :w] = np.bincount(place[here, k], weights=n[here], minlength=w)
                totals[i, k, :w] = np.bincount(place[here, k], weights=left[here], minlength=w)
        return counts, totals

    while True:
        yield sums
        left -= n * model.of_bins(place, model.trees[-1:])


def _node_column(tree: list[Node], keys: Sequence[str], node: int = 0) -> Column:
    """The node a row ends in, as nested conditions: a tree has few nodes."""
    own = tree[node]
    if own.feature < 0:
        return F.lit(node)
    return F.when(F.col(keys[own.feature]) < own.cut, _node_column(tree, keys, own.left)).otherwise(
        _node_column(tree, keys, own.right)
    )


def _on_spark(cells: DataFrame, keys: Sequence[str], model: Boosted, widths: Sequence[int]):
    """Sums of round after round from a stored table of cells, which each round writes anew."""
    left = cells.select(*keys, "n", (F.col("s") - F.col("n") * F.lit(model.start)).alias("left"))

    def sums(tree: list[Node], open_: list[int]) -> tuple[np.ndarray, np.ndarray]:
        pairs = F.array(*[F.struct(F.lit(k).alias("feature"), F.col(b).alias("bin")) for k, b in enumerate(keys)])
        rows = (
            left.withColumn("node", _node_column(tree, keys))
            .filter(F.col("node").isin(open_))
            .select("node", "n", "left", F.inline(pairs))
            .groupBy("node", "feature", "bin")
            .agg(F.sum("n").alias("n"), F.sum("left").alias("left"))
            .collect()  # open nodes x features x bins
        )
        shape = (len(open_), len(keys), max(widths, default=1))
        counts, totals = np.zeros(shape), np.zeros(shape)
        for r in rows:
            counts[open_.index(r["node"]), r["feature"], r["bin"]] = r["n"]
            totals[open_.index(r["node"]), r["feature"], r["bin"]] = r["left"]
        return counts, totals

    while True:
        yield sums
        tree = model.trees[-1]
        values = F.array(*[F.lit(model.step * node.value) for node in tree])
        moved = F.col("left") - F.col("n") * F.get(values, _node_column(tree, keys))
        left = stage(left.withColumn("left", moved), "boosting-left")


def prediction(features: Sequence[str], model: Boosted) -> Column:
    """The predictions of a model from columns of features."""

    @F.pandas_udf("double")
    def apply(*values: pd.Series) -> pd.Series:
        return pd.Series(model.predict(np.stack([v.to_numpy(float) for v in values], axis=1)))

    return apply(*[F.col(f"`{f}`").cast("double") for f in features])


def first_split(model: Boosted, features: Sequence[str]) -> tuple[str, float, float, float] | None:
    """Feature, threshold and the means of both sides of the first tree's root; None if it has no split."""
    tree = model.trees[0]
    root = tree[0]
    if root.feature < 0:
        return None
    sides = [model.start + tree[k].value for k in (root.left, root.right)]
    return features[root.feature], float(model.cuts[root.feature][root.cut - 1]), *sides
