"""A table by day that is written again and again: a rerun replaces its days and no others.

Every write goes to folders of its own (``data/run=.../<day>=...``). Once all of it is there, one file in
``manifest`` says which days it holds. A day is read from the last run that lists it, so a write that was
cut off changes nothing, and no day is ever seen half.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodline.operators.lookup import fits_broadcast
from moodline.sources.sinks import write_table

RUN = "run"


def write_days(
    df: DataFrame, path: str, day: str = "date", days: Sequence[date] | None = None
) -> str:
    """Write the days of ``df``; gives the run's name.

    ``days`` are replaced too if they have no rows now; rows of other days are then an error. Rows without
    a day are a day of their own.
    """
    root, spark, run = path.rstrip("/"), df.sparkSession, f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    if RUN in df.columns:
        raise ValueError(f"a column may not be called {RUN!r}")
    where = f"{root}/data/{RUN}={run}"
    write_table(df, where, [day])
    kind = df.schema[day].dataType
    written = spark.read.schema(df.schema).parquet(where).select(F.col(day).cast(kind).alias("day")).distinct()
    if days is not None:
        given = spark.createDataFrame([(d,) for d in days], "day date").select(F.col("day").cast(kind))
        if not written.join(given, written["day"].eqNullSafe(given["day"]), "left_anti").isEmpty():
            raise ValueError("rows of days that are not to be replaced")
        written = given.distinct()
    # one file: there in whole or not at all
    listed = written.select("day", F.lit(run).alias(RUN), F.lit(df.schema.json()).alias("schema"))
    listed.coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return run


def finished_days(spark: SparkSession, path: str) -> DataFrame | None:
    """(day, run): the last finished run of every day; None before the first write."""
    try:
        manifest = spark.read.parquet(f"{path.rstrip('/')}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return manifest.groupBy("day").agg(F.max(RUN).alias(RUN))


def read_days(spark: SparkSession, path: str, day: str = "date") -> DataFrame:
    """The rows of every day's last finished run. Folders of other runs are not read."""
    last = finished_days(spark, path)
    if last is None:
        raise ValueError(f"nothing was written yet: {path}")
    root = path.rstrip("/")
    text = spark.read.parquet(f"{root}/manifest").agg(F.max_by("schema", RUN)).first()[0]
    schema = T.StructType.fromJson(json.loads(text))
    with_run = T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])
    rows = spark.read.schema(with_run).option("basePath", f"{root}/data").parquet(f"{root}/data")
    # a row per day: the calendar bounds it, and it is measured
    chosen = F.broadcast(last) if fits_broadcast(last) else last
    kept = rows.join(chosen, (rows[RUN] == last[RUN]) & rows[day].eqNullSafe(last["day"]), "left_semi")
    return kept.select(*schema.names)
