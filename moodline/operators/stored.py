"""Scoring with stored parameters: many models at once, as a join of long-form features with their table."""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodline.operators.lookup import fits_broadcast
from moodline.operators.moments import INTERCEPT

# Code of this module travels to the Python workers with the job, so they need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def read_params(spark: SparkSession, root: str) -> DataFrame:
    """(run, feature, beta) of all parameter files below a folder, whatever their features are.

    ``run`` is the folder's path below ``root``: split, scorer, feature set and model.
    """

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for run, text in zip(frame["run"], frame["value"], strict=True):
                for line in csv.DictReader(io.StringIO(text)):
                    out += [(run, name, float(v)) for name, v in line.items() if name != "params"]
            yield pd.DataFrame(out, columns=["run", "feature", "beta"])

    base = root.rstrip("/")
    files = spark.read.option("recursiveFileLookup", True).text(base, wholetext=True, pathGlobFilter="*.csv")
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    name = F.regexp_extract(folder, r"([^/]+/[^/]+)_params$", 1)
    return files.select(F.url_decode(name).alias("run"), "value").mapInPandas(rows, "run string, feature string, beta double")


def apply_params(df: DataFrame, params: DataFrame, keep: Sequence[str] = ("date",)) -> DataFrame:
    """(keep..., run, prediction): every row scored by every run of ``params``.

    A run whose features ``df`` lacks is an error. A missing value counts as 0 for a run without
    intercept and gives no prediction for one with it. Rows are told apart by themselves, so ``keep`` may repeat.
    """
    numbers = [f.name for f in df.schema.fields if f.name not in keep]
    values = F.array(
        F.struct(F.lit(INTERCEPT).alias("feature"), F.lit(1.0).alias("value")),
        *[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value")) for c in numbers],
    )
    sizes = params.groupBy("run").agg(
        F.count(F.lit(1)).alias("size"), F.bool_or(F.col("feature") == INTERCEPT).alias("centred")
    )
    table = params.join(sizes, "run")
    # numbered in a step of its own: beside the generator every feature would get a number
    long = df.withColumn("_row", F.monotonically_increasing_id()).select("_row", *keep, F.inline(values))
    # a row for each run and feature: small, and measured
    scored = long.join(F.broadcast(table) if fits_broadcast(params) else table, "feature")
    none = F.bool_or(F.col("value").isNull() | F.isnan("value"))
    by_run = scored.groupBy("_row", *keep, "run", "size", "centred").agg(
        F.count(F.lit(1)).alias("found"),
        F.sum(F.col("beta") * F.nanvl(F.coalesce("value", F.lit(0.0)), F.lit(0.0))).alias("total"),
        none.alias("missing"),
    )
    lacking = F.concat(F.lit("features of a stored run are missing: "), "run")
    prediction = F.when(F.col("found") < F.col("size"), F.raise_error(lacking).cast("double")).when(
        ~(F.col("centred") & F.col("missing")), F.col("total")
    )
    return by_run.select(*keep, "run", prediction.alias("prediction"))
