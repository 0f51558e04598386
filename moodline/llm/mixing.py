"""Mixing sources to target weights by the cube method.

Every source gets a target number of words. A document of a source with target t and size s is due
t / s times: the whole part is certain, the rest is its inclusion probability. The flight phase of
the cube method (Deville & Tille 2004) moves these probabilities along the null space of the
constraints, here the source's totals of words and of documents, until all but two of a block are
0 or 1. Blocks of a source are flown side by side; what is left of them meets in fewer blocks,
round by round, until the landing problem of a source is two documents, which are rounded so that
the source comes nearest to its target.

Sizes of 0 take no part and are taken 0 times. A null text has size 0; a null source is a source
of its own, the last one. Repeated rows are separate documents. Blocks, and the order within them, are
drawn from a hash of id, source and text and, among equal rows, of their rank, so reruns agree however
the rows are dealt out; which of equal rows has which rank makes no difference to the mix. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodline.llm.common import WORD, numbered, stored_rows, unpacked
from moodline.operators.lookup import fits_broadcast
from moodline.session import stage

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5  # of all words
MOST = 2.0  # times its size that a source or document is taken
BLOCK = 1024  # documents flown together, about
EPS = 1e-9

UNIT = "rid long, src int, size long, p double, mix long"


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source, src, source_size, target of each source in ``sizes`` (source, size).

    Sources that would pass ``most`` times their size stop there; the others share the excess by
    weight. Only two sums a round come to the driver; a round stops at least one source.
    """
    n = len(weights)
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("src") % n + 1)
    totals = stage(in_order(by_source).withColumn("weight", weight), "mix-sources")
    wanted = share * (totals.agg(F.sum("source_size")).first()[0] or 0)
    cap = F.lit(float(most)) * F.col("source_size")
    level = 0.0
    while True:
        full = F.lit(level) * F.col("weight") >= cap
        held, weight = totals.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        rising = (wanted - held) / weight if weight > 0 else level
        if rising <= level * (1 + 1e-12):
            break
        level = rising
    return totals.select(
        "source", "src", "source_size", F.least(F.lit(level) * F.col("weight"), cap).alias("target")
    )


def in_order(sources: DataFrame) -> DataFrame:
    """Sources numbered (``src``) by code point, null last: a sort by ranges, and each range's offset."""
    ordered = sources.orderBy(F.col("source").isNull(), "source")
    rows = stage(ordered.withColumn("place", F.monotonically_increasing_id()), "mix-ordered")
    part = F.shiftright("place", 33)
    offsets, at = [], 0
    for x in rows.groupBy(part.alias("part")).count().orderBy("part").collect():  # a row for each task
        offsets.append((x["part"], at))
        at += x["count"]
    table = sources.sparkSession.createDataFrame(offsets or [(0, 0)], "part long, at long")
    number = F.col("at") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    placed = rows.withColumn("part", part).join(F.broadcast(table), "part")
    return placed.select("source", "source_size", number.cast("int").alias("src"))


def ranked(units: DataFrame) -> DataFrame:
    """Units with ``mix``, a hash of their content, made distinct by the rank among equal ones.

    Equal rows are ranked within the part of the scan they come from, and parts follow one another: a
    content that a third of all rows share is not ranked by one task.
    """
    part = F.shiftright("rid", 33)
    inside = F.row_number().over(Window.partitionBy("mix", part).orderBy("rid"))
    counts = units.groupBy("mix", part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    several = Window.partitionBy("mix").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # only contents of more than one part have an offset; a row for each of these parts
    offsets = counts.select("mix", "part", F.sum("n").over(several).alias("before")).filter("before > 0")
    placed = units.withColumns({"part": part, "inside": inside})
    rank = F.col("inside") + F.coalesce("before", F.lit(0))
    return placed.join(offsets, ["mix", "part"], "left").withColumn(
        "mix", F.when(rank > 1, F.xxhash64("mix", rank)).otherwise(F.col("mix"))
    ).select(*units.columns)


def fly(p: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The flight phase with the constraints sum(p) and sum(p * size).

    Keeps three open documents. Their null vector is the cross product of (1, 1, 1) and their
    sizes; moving along it closes one of them at least, which the next one replaces. The side is
    drawn so that every p keeps its expectation.
    """
    p = p.tolist()
    x = size.astype(float).tolist()
    draws = np.random.default_rng(len(p)).random(len(p) + 8).tolist()
    open_: list[int] = []
    for k in range(len(p)):
        if p[k] <= EPS or p[k] >= 1 - EPS:
            p[k] = float(round(p[k]))
            continue
        open_.append(k)
        if len(open_) < 3:
            continue
        a, b, c = open_
        u = (x[c] - x[b], x[a] - x[c], x[b] - x[a])
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        up = down = 1e300
        for i, v in zip(open_, u, strict=True):
            if v > 0:
                up, down = min(up, (1 - p[i]) / v), min(down, p[i] / v)
            elif v < 0:
                up, down = min(up, -p[i] / v), min(down, -(1 - p[i]) / v)
        step = up if draws.pop() * (up + down) < down else -down
        for i, v in zip(open_, u, strict=True):
            p[i] += step * v
        still = []
        for i in open_:
            if EPS < p[i] < 1 - EPS:
                still.append(i)
            else:
                p[i] = float(round(p[i]))
        open_ = still
    return np.array(p), open_


def in_flight_order(frame: pd.DataFrame) -> pd.DataFrame:
    """Large documents first: most of those still open at the end are small."""
    return frame.sort_values(["size", "mix"], ascending=[False, True], kind="stable").reset_index(drop=True)


def _flown(frame: pd.DataFrame) -> pd.DataFrame:
    frame = in_flight_order(frame)
    p, _ = fly(frame["p"].to_numpy(), frame["size"].to_numpy())
    return frame.assign(p=p)


def _landed(frame: pd.DataFrame) -> pd.DataFrame:
    """The last flight of a source, then the landing problem of its two open documents.

    They are rounded to the nearest total of words; the one document whose change of side brings
    the total nearest to what is due settles the rest.
    """
    frame = in_flight_order(frame)
    size = frame["size"].to_numpy()
    due = float((frame["p"] * size).sum())
    p, rest = fly(frame["p"].to_numpy(), size)
    off = float((p * size).sum()) - float((p[rest] * size[rest]).sum()) - due
    best = min(
        range(1 << len(rest)),
        key=lambda m: (abs(sum(size[i] for k, i in enumerate(rest) if m >> k & 1) + off), m),
    )
    p[rest] = [float(best >> k & 1) for k in range(len(rest))]
    change = size * (1 - 2 * p)
    off = float((p * size).sum()) - due
    nearest = int(np.argmin(np.abs(off + change)))
    if abs(off + change[nearest]) < abs(off):
        p[nearest] = 1 - p[nearest]
    return frame.assign(p=p)


def sampled(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """rid, extra (0 or 1) of the units (UNIT columns) whose p lies between 0 and 1.

    A round flies all blocks at once and stores its result; open documents fall from n to
    2 n / block, so the number of rounds grows with the logarithm of n.
    """
    done: DataFrame | None = None
    left = units
    while True:
        most = left.groupBy("src").count().agg(F.max("count")).first()[0] or 0
        # blocks of a source hold equal shares of the hash, so a hot source is many blocks
        last = most <= block
        blocks = max(1, -(-most // block))
        place = F.pmod(F.xxhash64("mix"), F.lit(blocks)) if not last else F.lit(0)
        flown = left.withColumn("place", place).groupBy("src", "place").applyInPandas(
            lambda f: (_landed if last else _flown)(f.drop(columns="place")), UNIT
        )
        flown = stage(flown, "mix-flight")
        closed = flown.filter("p = 0 or p = 1")
        done = closed if done is None else done.unionByName(closed)
        if last:
            return done.select("rid", F.col("p").cast("int").alias("extra"))
        left = flown.filter("p > 0 and p < 1")


def _planned(rows: DataFrame, id_col: str, text_col: str, source_col: str, weights, share, most, block):
    size = F.coalesce(F.regexp_count(F.col(f"row.`{text_col}`").cast("string"), F.lit(WORD)), F.lit(0))
    sizes = stage(
        rows.select(
            "rid",
            F.col(f"row.`{id_col}`").alias("id"),
            F.col(f"row.`{source_col}`").cast("string").alias("source"),
            size.cast("long").alias("size"),
            F.xxhash64(F.col(f"row.`{text_col}`").cast("string")).alias("text_hash"),
        ),
        "mix-sizes",
    )
    aims = stage(targets(sizes, weights, share, most), "mix-targets")
    same = F.col("s.source").eqNullSafe(F.col("t.source"))
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # a row for each source: few, or as many as a crawl has hosts, so it is measured
    known = aims if not fits_broadcast(aims.select("source", "src")) else F.broadcast(aims)
    joined = sizes.alias("s").join(known.alias("t"), same).select(
        "rid", "id", "size", "text_hash", "src", "source_size", "target", due.alias("due"),
    )
    whole = F.floor(F.col("due") + EPS)
    share_of = F.greatest(F.col("due") - whole, F.lit(0.0))
    units = joined.filter(F.col("size") > 0).select(
        "rid", "src", "size", share_of.alias("p"), F.xxhash64("id", "text_hash", "src").alias("mix")
    ).filter(F.col("p") > EPS)
    # written once: the blocks of a round must not change between its passes
    extra = sampled(stage(ranked(units), "mix-units"), block)
    times = F.when(F.col("size") > 0, whole + F.coalesce("extra", F.lit(0))).otherwise(0)
    return joined.join(extra, "rid", "left").withColumn("times", times.cast("int"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, times."""
    plan = _planned(numbered(docs), id_col, text_col, source_col, weights, share, most, block)
    return plan.select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("times")).alias("taken"),
        "times",
    )


def take(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block: int = BLOCK,
) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken."""
    rows = stored_rows(docs, "mix-rows")
    plan = stage(
        _planned(rows, id_col, text_col, source_col, weights, share, most, block)
        .filter("times > 0")
        .select("rid", "times"),
        "mix-plan",
    )
    # narrow, so the texts stay where they are if it is measured small
    rows = rows.join(F.broadcast(plan) if fits_broadcast(plan) else plan, "rid")
    return unpacked(
        rows.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("times")))), docs
    )
