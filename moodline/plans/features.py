"""Feature tables: daily sentiment joined with the daily label, one row per day."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodline.functions.measures import softsign
from moodline.operators.daily import (
    daily_mean,
    daily_ratio_long,
    daily_ratio_one,
    daily_ratio_wide,
    pivot_entities,
    trailing_mean,
    with_day,
)
from moodline.operators.labels import join_labels
from moodline.operators.prepare import quality_filter
from moodline.schemas import label_of, mention


def ratios_from_long(
    sentiment: DataFrame, labels: DataFrame, entities: Sequence[str]
) -> DataFrame:
    """One ratio per entity from (timestamp, candidate, sentiment_label) rows."""
    daily = daily_ratio_long(with_day(sentiment), entities)
    return join_labels(pivot_entities(daily, entities, ["ratio"]), labels)


def ratio_from_long(sentiment: DataFrame, labels: DataFrame, entity: str) -> DataFrame:
    """The ratio of one entity from (timestamp, candidate, sentiment_label) rows."""
    daily = daily_ratio_one(with_day(sentiment.filter(F.col("candidate") == entity)))
    return join_labels(daily.select("date", "ratio"), labels)


def ratios_from_wide(
    sentiment: DataFrame,
    labels: DataFrame,
    entities: Sequence[str],
    *,
    mentions_only: bool = False,
) -> DataFrame:
    """One ratio per entity from rows with a label column per entity."""
    daily = daily_ratio_wide(with_day(sentiment), entities, mentions_only=mentions_only)
    return join_labels(daily, labels)


def ratio_from_wide(sentiment: DataFrame, labels: DataFrame, entity: str) -> DataFrame:
    """The ratio of one entity over the rows that mention it."""
    rows = with_day(sentiment.filter(F.col(mention(entity)) == 1))
    daily = daily_ratio_one(rows, label=label_of(entity))
    return join_labels(daily.select("date", "ratio"), labels)


def enhanced_from_long(
    sentiment: DataFrame,
    labels: DataFrame,
    entities: Sequence[str],
    *,
    per_entity: bool = False,
    **quality: object,
) -> DataFrame:
    """Filtered posts; per entity a damped mean, the mean and its trailing mean; and the
    label with its trailing mean.

    The trailing mean of the features runs over the rows in (date, entity) order, so
    it mixes the entities, unless ``per_entity`` is set.
    """
    daily = daily_mean(with_day(quality_filter(sentiment, **quality)), entities)
    order = ["date"] if per_entity else ["date", "candidate"]
    fields = daily.withColumns(
        {
            "rolling_sentiment_indic": trailing_mean(
                "sentiment_indic", order, per=["candidate"] if per_entity else []
            ),
            "ratio": softsign("sentiment_indic"),
        }
    )
    wide = pivot_entities(
        fields, entities, ["ratio", "sentiment_indic", "rolling_sentiment_indic"]
    )
    return join_labels(wide, labels).withColumn("p_win_rolling", trailing_mean("p_win", ["date"]))


# The feature sets a run may ask for, by split.
TWO_RATIOS, ONE_RATIO, ENHANCED = "2RATIOS", "1RATIO", "ENHANCED"

FEATURES: dict[tuple[str, str], Callable[..., DataFrame]] = {
    ("train", TWO_RATIOS): ratios_from_long,
    ("train", ONE_RATIO): ratio_from_long,
    ("train", ENHANCED): enhanced_from_long,
    ("test", TWO_RATIOS): ratios_from_wide,
    ("test", ONE_RATIO): ratio_from_wide,
}


def build_features(
    sentiment: DataFrame,
    labels: DataFrame,
    entities: Sequence[str],
    name: str,
    *,
    split: str = "train",
    **options: object,
) -> DataFrame:
    """The named feature table; a one-ratio table is about the first entity."""
    builder = FEATURES.get((split, name))
    if builder is None:
        raise ValueError(f"unknown feature set for {split!r}: {name!r}")
    about = entities[0] if name == ONE_RATIO else entities
    return builder(sentiment, labels, about, **options)
