"""Tagging sources with their entity, union, and merging of copies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodline.functions.measures import nan_to_null
from moodline.functions.text import mention_flag
from moodline.functions.time import account_age_days
from moodline.schemas import mention

SOURCE_RANK = "source_rank"


def tag_sources(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Union of one table per entity; a row mentions the entity of its source.

    Columns missing from a source become null. ``source_rank`` keeps the order in
    which the sources were given.
    """
    if not sources:
        raise ValueError("at least one source is needed")
    tagged = [
        df.withColumns(
            {
                **{mention(e): F.lit(int(e == entity)) for e in sources},
                SOURCE_RANK: F.lit(rank),
            }
        )
        for rank, (entity, df) in enumerate(sources.items())
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def propagate_flags(df: DataFrame, key: str, entities: Sequence[str]) -> DataFrame:
    """All rows, each flag raised to its maximum over the rows of the same key.

    Rows without a key lose their flags. To go on with one row per key, use
    ``merge_duplicates`` alone. The maxima are aggregated and joined back, since a
    window would bring all rows of a key into one task; adaptive execution splits the
    join where a key is that frequent.
    """
    flags = [mention(e) for e in entities]
    highest = df.groupBy(key).agg(*[F.max(flag).alias(flag) for flag in flags])
    return df.drop(*flags).join(highest, key, "left")


def merge_duplicates(
    df: DataFrame, key: str, entities: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key: the first by ``order``, with every flag at its maximum over the copies.

    Rows without a key count as copies of each other and lose their flags. This is
    an aggregate and not a window, so copies shrink to one row per task before the
    shuffle: a key that holds a third of all rows costs no more than any other.
    """
    flags = [mention(e) for e in entities]
    kept = [c for c in df.columns if c not in flags and c != key]
    merged = df.groupBy(key).agg(
        *[F.max(flag).alias(flag) for flag in flags],
        F.min_by(F.struct(*kept), F.struct(*order)).alias("_first"),
    )
    return merged.select(
        key,
        *[F.col(f"_first.{c}").alias(c) for c in kept],
        *[F.when(F.col(key).isNotNull(), F.col(flag)).alias(flag) for flag in flags],
    )


def flag_mentions(df: DataFrame, text: str, entities: Sequence[str]) -> DataFrame:
    """One 0/1 column per entity, 1 where the text has it as a whole word."""
    return df.withColumns({mention(e): mention_flag(text, e) for e in entities})


def quality_filter(
    df: DataFrame,
    *,
    min_account_age: float = 30,
    min_followers: float = 5,
    min_likes: float = 5,
    english_only: bool = True,
    at: str = "timestamp",
    joined: str = "user_join_date",
    followers: str = "user_followers_count",
    likes: str = "likes",
    is_english: str = "is_en",
) -> DataFrame:
    """Rows strictly above every minimum; unknown values do not pass."""
    out = df.withColumn("account_age", account_age_days(at, joined)).filter(
        (F.col("account_age") > min_account_age)
        & (nan_to_null(F.col(followers).cast("double")) > min_followers)
        & (nan_to_null(F.col(likes).cast("double")) > min_likes)
    )
    return out.filter(F.col(is_english)) if english_only else out
