"""Metrics of predictions against true values, each set from one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.functions.measures import binarise

CUT = 0.5


def _share(hits: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(hits.cast("double"), total.cast("double")), F.lit(0.0))


def evaluate(
    df: DataFrame, truth: str, prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """One row (for each value of ``by``): n, accuracy, below_accuracy, above_accuracy, mae, rmse, r2, mape.

    ``accuracy`` calls only values above 0.5 a win; the accuracies per class call
    everything not below 0.5 one, so exactly 0.5 falls on different sides. A class
    without rows scores 0. ``mape`` is in percent and infinite if a true value of 0
    was missed.
    """
    y, p = F.col(truth).cast("double"), F.col(prediction).cast("double")
    error = y - p
    below, right = y < CUT, (y < CUT) == (p < CUT)
    sse, sst = F.sum(error * error), F.var_pop(y) * F.count(y)
    missed_zero = F.when(error == 0, F.lit(None)).otherwise(F.lit(float("inf")))
    relative = F.when(y == 0, missed_zero).otherwise(F.abs(F.try_divide(error, y)))
    rows = df.filter(y.isNotNull() & p.isNotNull())
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((binarise(y) == binarise(p)).cast("double")).alias("accuracy"),
        _share(F.count_if(below & right), F.count_if(below)).alias("below_accuracy"),
        _share(F.count_if(~below & right), F.count_if(~below)).alias("above_accuracy"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.when(sst > 0, F.lit(1.0) - F.try_divide(sse, sst))
        .otherwise(F.when(sse == 0, 1.0).otherwise(0.0))
        .alias("r2"),
        (F.avg(relative) * 100).alias("mape"),
    )


def class_counts(df: DataFrame, truth: str, prediction: str = "prediction") -> DataFrame:
    """(kind, class, n): how many true and predicted values lie above the cut."""
    rows = F.array(
        F.struct(F.lit("actual").alias("kind"), binarise(truth).alias("class")),
        F.struct(F.lit("predicted").alias("kind"), binarise(prediction).alias("class")),
    )
    pairs = df.filter(F.col(truth).isNotNull() & F.col(prediction).isNotNull())
    return pairs.select(F.inline(rows)).groupBy("kind", "class").agg(F.count(F.lit(1)).alias("n"))
