"""Writing stage tables, interchange files and model parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodline.functions.time import to_epoch_ms
from moodline.operators.models import Fit


MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"  # the writers' own format stops at milliseconds


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header and doubled quotes; blanks at the ends of values are kept."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampFormat", MICROSECONDS)
        .csv(path)
    )


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Parquet. A partitioned table is rebalanced on its partition columns first: files get
    an even size, small values share a task, and a value that holds much of the table is
    split over several."""
    if not partition_by:
        df.write.mode(mode).parquet(path)
        return
    df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_articles(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Articles as JSON, one record per line."""
    df.write.mode(mode).option("timestampFormat", MICROSECONDS).json(path)


def news_records(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Processed news with its timestamp as epoch milliseconds, as the files carry it."""
    return df.withColumn(timestamp, to_epoch_ms(timestamp))


def write_news_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Processed news as JSON, one record per line."""
    news_records(df).write.mode(mode).json(path)


def params_path(root: str, split: str, sentiment: str, features: str, model: str) -> str:
    return f"{root.rstrip('/')}/{split}/{sentiment}_{features}_{model}_params"


def params_row(fit: Fit) -> DataFrame:
    """One row named ``betas`` with a column per feature."""
    names = list(fit.betas)
    return (
        fit.params()
        .groupBy(F.lit("betas").alias("params"))
        .pivot("feature", names)
        .agg(F.first("beta"))
    )


def write_params(
    fit: Fit, root: str, split: str, sentiment: str, features: str, mode: str = "overwrite"
) -> str:
    """Store the coefficients of a fit under its run's name; returns the path."""
    path = params_path(root, split, sentiment, features, fit.name)
    write_csv(params_row(fit), path, mode)
    return path
