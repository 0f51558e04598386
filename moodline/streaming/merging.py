"""Merging copies of posts batch by batch: the table of one run over everything, without reading old texts again.

The store has two parts. ``rows`` takes from every batch the rows that were the first of their key when they
came, texts included, and is only added to. ``keys`` is narrow: for every key its flags so far and the order
and batch of its first row. A batch is merged by itself, then with the keys alone; a new version of
the keys is finished when its name is in ``versions``, so a batch that was cut off is as if it had never come
and may be given again. Reading joins the keys with the rows they point to.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodline.operators.prepare import SOURCE_RANK, merge_duplicates, tag_sources
from moodline.schemas import mention
from moodline.session import stage

BATCH, ORDER = "_batch", "_order"


def _last_version(spark: SparkSession, root: str) -> str | None:
    try:
        return spark.read.parquet(f"{root}/versions").agg(F.max("version")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _known(spark: SparkSession, root: str) -> DataFrame | None:
    version = _last_version(spark, root)
    return None if version is None else spark.read.parquet(f"{root}/keys/{version}")


def add_batch(
    spark: SparkSession,
    path: str,
    sources: Mapping[str, DataFrame],
    entities: Sequence[str],
    *,
    key: str = "tweet_id",
    row_order: str = "row_order",
) -> None:
    """Take in new rows: tables by entity, in any split of files into batches.

    ``entities`` are all entities, in the order that decides between sources; a batch may lack some.
    ``row_order`` must order the rows of a source over all batches, as ``with_file_order`` does.
    """
    unknown = set(sources) - set(entities)
    if unknown:
        raise ValueError(f"unknown entities: {sorted(unknown)}")
    flags, root = [mention(e) for e in entities], path.rstrip("/")
    batch = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    ranks = {e: i for i, e in enumerate(entities)}
    tagged = tag_sources({e: df.withColumn("_rank", F.lit(ranks[e])) for e, df in sources.items()})
    tagged = tagged.withColumn(SOURCE_RANK, F.col("_rank")).drop("_rank")
    tagged = tagged.withColumns({f: F.lit(0) for f in flags if f not in tagged.columns})
    # the flags of rows without a key come back below: they are lost at the end, as in one run
    merged = stage(merge_duplicates(tagged, key, list(entities), [SOURCE_RANK, row_order]), "merge-batch")
    order = F.struct(SOURCE_RANK, row_order)
    new = merged.select(F.col(key).alias("key"), order.alias(ORDER), *flags, F.lit(batch).alias(BATCH))
    old = _known(spark, root)
    if old is not None:
        new = old.unionByName(new)
    # by order, not by arrival: a later batch may hold an earlier row
    keys = new.groupBy("key").agg(
        F.min_by(F.struct(ORDER, BATCH), F.struct(ORDER, BATCH)).alias("first"), *[F.max(f).alias(f) for f in flags]
    )
    keys.select("key", f"first.{ORDER}", f"first.{BATCH}", *flags).write.parquet(f"{root}/keys/{batch}")
    merged_keys = spark.read.parquet(f"{root}/keys/{batch}").filter(F.col(BATCH) == batch)
    wins = merged.join(merged_keys.select("key"), merged[key].eqNullSafe(merged_keys["key"]), "left_semi")
    kept = [c for c in merged.columns if c not in flags]
    wins.select(*kept).withColumn(BATCH, F.lit(batch)).write.partitionBy(BATCH).mode("append").parquet(f"{root}/rows")
    done = spark.createDataFrame([(batch,)], "version string")
    done.coalesce(1).write.mode("append").parquet(f"{root}/versions")


def merged_rows(spark: SparkSession, path: str, entities: Sequence[str], *, key: str = "tweet_id") -> DataFrame:
    """The merged table: what ``merge_duplicates`` makes of all batches at once."""
    root = path.rstrip("/")
    keys = _known(spark, root)
    if keys is None:
        raise ValueError(f"no batch was taken in yet: {path}")
    flags = [mention(e) for e in entities]
    rows = spark.read.option("mergeSchema", True).parquet(f"{root}/rows")
    found = rows.join(
        keys.select(F.col("key").alias("_key"), F.col(BATCH).alias("_of"), *flags),
        rows[key].eqNullSafe(F.col("_key")) & (rows[BATCH] == F.col("_of")),
    )
    shown = [c for c in rows.columns if c not in (key, BATCH)]
    # rows without a key count as copies of each other and have no flags
    return found.select(key, *shown, *[F.when(F.col(key).isNotNull(), F.col(f)).alias(f) for f in flags])
