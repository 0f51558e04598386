"""Daily roll-ups per entity, pivots and trailing means.

After the first ``groupBy`` every table here has at most one row per day and listed
entity. Days are bounded by the calendar and entities by the caller's list, so the
windows below, which run over the whole series in date order, are bounded too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodline.functions.measures import label_indicator, ratio_of
from moodline.functions.time import utc_day
from moodline.schemas import label_of, mention, score_of

ROLLING_ROWS = 7


def with_day(df: DataFrame, timestamp: str = "timestamp", day: str = "date") -> DataFrame:
    return df.withColumn(day, utc_day(timestamp))


def _indicator_total(indicator: Column) -> Column:
    # the sum over a group without labels is 0, as a sum of nothing
    return F.coalesce(F.sum(indicator), F.lit(0))


def daily_ratio_long(
    df: DataFrame,
    entities: Sequence[str],
    *,
    day: str = "date",
    candidate: str = "candidate",
    label: str = "sentiment_label",
) -> DataFrame:
    """(date, candidate, sum, count, ratio): net share of positive labels per day and entity."""
    indicator = label_indicator(label)
    return (
        df.filter(F.col(day).isNotNull() & F.col(candidate).isin(*entities))
        .groupBy(day, candidate)
        .agg(_indicator_total(indicator).alias("sum"), F.count(indicator).alias("count"))
        .withColumn("ratio", ratio_of(F.col("sum"), F.col("count")))
    )


def daily_ratio_one(
    df: DataFrame, *, day: str = "date", label: str = "sentiment_label"
) -> DataFrame:
    """(date, sum, count, ratio) over rows already filtered to one entity."""
    indicator = label_indicator(label)
    return (
        df.filter(F.col(day).isNotNull())
        .groupBy(day)
        .agg(_indicator_total(indicator).alias("sum"), F.count(indicator).alias("count"))
        .withColumn("ratio", ratio_of(F.col("sum"), F.col("count")))
    )


def daily_ratio_wide(
    df: DataFrame, entities: Sequence[str], *, day: str = "date", mentions_only: bool = False
) -> DataFrame:
    """(date, {entity}_ratio...) in one pass.

    All labelled rows count, also the neutral ones of rows that do not mention the
    entity, unless ``mentions_only`` is set.
    """
    totals, ratios = [], []
    for e in entities:
        indicator = label_indicator(label_of(e))
        if mentions_only:
            indicator = F.when(F.col(mention(e)) == 1, indicator)
        totals += [
            _indicator_total(indicator).alias(f"_{e}_sum"),
            F.count(indicator).alias(f"_{e}_count"),
        ]
        ratios.append(ratio_of(F.col(f"_{e}_sum"), F.col(f"_{e}_count")).alias(f"{e}_ratio"))
    return df.filter(F.col(day).isNotNull()).groupBy(day).agg(*totals).select(day, *ratios)


def daily_mean(
    df: DataFrame,
    entities: Sequence[str],
    *,
    day: str = "date",
    candidate: str = "candidate",
    label: str = "sentiment_label",
) -> DataFrame:
    """(date, candidate, sentiment_indic): mean indicator per day and entity."""
    return (
        df.filter(F.col(day).isNotNull() & F.col(candidate).isin(*entities))
        .groupBy(day, candidate)
        .agg(F.avg(label_indicator(label)).alias("sentiment_indic"))
    )


def trailing_mean(
    value: Column | str,
    order: Sequence[str],
    *,
    per: Sequence[str] = (),
    rows: int = ROLLING_ROWS,
) -> Column:
    """Mean of the last ``rows`` rows, this one included; nulls do not count."""
    window = Window.partitionBy(*per).orderBy(*order).rowsBetween(-(rows - 1), 0)
    return F.avg(value).over(window)


def pivot_entities(
    df: DataFrame,
    entities: Sequence[str],
    fields: Sequence[str],
    *,
    day: str = "date",
    candidate: str = "candidate",
) -> DataFrame:
    """One row per day. The first field is named after the entity, the others entity_field.

    A second row for the same day and entity is an error, not a silent choice.
    """

    def single(entity: str, field: str) -> Column:
        here = F.col(candidate) == entity
        twice = F.raise_error(F.lit(f"more than one row per day for {entity}"))
        return F.when(F.count_if(here) > 1, twice.cast("double")).otherwise(
            F.max(F.when(here, F.col(field)))
        )

    columns = [
        single(e, field).alias(e if i == 0 else f"{e}_{field}")
        for i, field in enumerate(fields)
        for e in entities
    ]
    return df.groupBy(day).agg(*columns)


def entity_summary(df: DataFrame, entities: Sequence[str]) -> DataFrame:
    """(entity, mentions, mean_score) over the rows that mention each entity, in one pass."""
    stats = df.agg(
        *[F.count_if(F.col(mention(e)) == 1).alias(f"_n_{e}") for e in entities],
        *[F.avg(F.when(F.col(mention(e)) == 1, F.col(score_of(e)))).alias(f"_m_{e}") for e in entities],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(e).alias("entity"),
                F.col(f"_n_{e}").alias("mentions"),
                F.col(f"_m_{e}").alias("mean_score"),
            )
            for e in entities
        ]
    )
    return stats.select(F.inline(rows))


def label_counts(df: DataFrame, entity: str) -> DataFrame:
    """(sentiment_label, n) of the rows that mention the entity, most frequent first."""
    label = label_of(entity)
    return (
        df.filter((F.col(mention(entity)) == 1) & F.col(label).isNotNull())
        .groupBy(F.col(label).alias("sentiment_label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "sentiment_label")
    )
