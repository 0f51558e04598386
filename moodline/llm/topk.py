"""Exact top-k search by inner product over an impact-ordered index, score at a time.

Vectors become integers, floor(scale * x). Within a cell of candidates every dimension's values are
cut into segments of equal quantised impact. A query takes the segments by descending product with
its own component and adds each as a whole to the accumulators of its candidates. At any point
the distance between an accumulator and the true score is at most the sum, over the dimensions, of
the largest impact not yet taken or of half a segment's width. Once this proves that all but few
candidates can't be among the k best, the others are scored exactly.

Queries meet all candidates cell by cell: candidates and queries are dealt to the cells of a grid,
so that neither side is gathered in one task or broadcast.

Vectors that are null, empty, or hold null or non-finite components take no part; nor do null ids.
Only vectors of equal length meet. A query's own row, found by its id, is no candidate. Repeated
candidate rows take a rank each; an id that is queried twice is searched once, by its smallest
vector. Ties go to smaller ids. Scores beyond 64 bits stop at the ends of their range. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodline.session import stage

SCALE = 256
LEVELS = 24  # segments of a dimension, about
CANDIDATES, QUERIES = 1 << 16, 256  # of a cell, about
FEW = 16  # stop when one in so many candidates may still be among the best
LOOKS = (0.35, 0.5, 0.65, 0.8)  # shares of the segments after which to look for the proof


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """vec_id, v (array of long) of the vectors that take part."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(
            F.col(f"`{id_col}`").cast("long").alias("vec_id"),
            F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
        )
        .filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad)
        .select("vec_id", F.transform(v, lambda x: F.floor(x * float(scale))).alias("v"))
    )


class ImpactIndex:
    """Posting segments of a block of candidates."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, levels: int = LEVELS):
        self.ids, self.vectors = ids, vectors
        low, high = int(vectors.min()), int(vectors.max())
        self.step = max(1, -(-(high - low + 1) // levels))
        level = vectors // self.step
        self.lists: list[np.ndarray] = []  # candidates of each segment
        dims, impacts = [], []
        for d in range(vectors.shape[1]):
            order = np.argsort(level[:, d], kind="stable").astype(np.int32)
            at = level[order, d]
            cuts = np.flatnonzero(at[1:] != at[:-1]) + 1
            self.lists += np.split(order, cuts)
            impacts.append(at[np.r_[0, cuts]])
            dims.append(np.full(len(cuts) + 1, d))
        self.dims = np.concatenate(dims)
        #: twice the middle of a segment; twice half its width is step - 1
        self.twice = 2 * np.concatenate(impacts) * self.step + self.step - 1

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """ids and exact scores of the k best."""
        others = self.ids != own
        n = int(others.sum())
        if not n:
            return self.ids[:0], self.ids[:0]
        largest = max(1, int(np.abs(query).max())) * max(1, int(np.abs(self.vectors).max()))
        if largest > 2**60 // len(query):
            limits = np.iinfo(np.int64)
            exact = np.clip(self.vectors.astype(object) @ query.astype(object), limits.min, limits.max)
            return self._best(np.flatnonzero(others), exact.astype(np.int64)[others], k)
        possible = np.flatnonzero(others) if n <= k else self._possible(query, others, k)
        return self._best(possible, self.vectors[possible] @ query, k)

    def _best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][order], scores[order]

    def _possible(self, query: np.ndarray, others: np.ndarray, k: int) -> np.ndarray:
        gain = query[self.dims] * self.twice
        order = np.argsort(-np.abs(gain), kind="stable")
        total = np.zeros(len(self.ids), np.int64)
        looks = {int(len(order) * share) for share in LOOKS} | {len(order)}
        weight, width = np.abs(query), self.step - 1
        reach = np.abs(self.twice) + width  # twice the largest impact in a segment
        gains, lists = gain.tolist(), self.lists
        for done, s in enumerate(order.tolist(), 1):
            if gains[s]:
                total[lists[s]] += gains[s]
            if done not in looks:
                continue
            rest = np.zeros(len(query), np.int64)
            np.maximum.at(rest, self.dims[order[done:]], reach[order[done:]])
            off = int((weight * np.maximum(rest, width)).sum())  # |total - twice the score| at most
            floor = np.partition(total[others], -k)[-k]
            possible = np.flatnonzero(others & (total >= floor - 2 * off))
            if done == len(order) or len(possible) * FEW <= len(total):
                break
        return possible


def _search(candidates: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    columns = ["query_id", "vec_id", "score"]
    if not len(candidates) or not len(queries):
        return pd.DataFrame({c: np.zeros(0, np.int64) for c in columns})
    index = ImpactIndex(candidates["vec_id"].to_numpy(), np.stack(candidates["v"].to_list()))
    found = []
    for own, query in zip(queries["vec_id"].tolist(), queries["v"], strict=True):
        ids, scores = index.top(np.asarray(query), own, k)
        found.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": scores}))
    return pd.concat(found)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    candidates: int = CANDIDATES,
    queries: int = QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score. ``is_query`` is a condition on ``vec_id``."""
    rows = stage(quantised(vectors, id_col, vector_col, scale), "topk-vectors")
    asked = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    n, m = rows.count(), rows.filter(is_query).count()
    down, across = max(1, -(-n // candidates)), max(1, -(-m // queries))

    def dealt(side: DataFrame, own: str, own_cells: int, other: str, other_cells: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(other_cells - 1)))
        return side.select(
            "vec_id",
            "v",
            F.size("v").alias("dims"),
            F.pmod(F.xxhash64("vec_id"), F.lit(own_cells)).cast("int").alias(own),
            every.alias(other),
        )

    cell = ["dims", "down", "across"]
    left = dealt(rows, "down", down, "across", across).groupBy(*cell)
    right = dealt(asked, "across", across, "down", down).groupBy(*cell)
    best = left.cogroup(right).applyInPandas(
        lambda a, b: _search(a, b, k), "query_id long, vec_id long, score long"
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
