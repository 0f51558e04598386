"""From raw posts or articles to processed text tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodline.functions.text import clean_text, compose_text
from moodline.functions.time import parse_timestamp
from moodline.operators.language import LanguageProfiles, flag_language
from moodline.operators.prepare import SOURCE_RANK, flag_mentions, merge_duplicates, tag_sources
from moodline.schemas import mention
from moodline.sources.files import ROW_ORDER, read_table
from moodline.sources.sinks import write_table


def merge_posts(
    sources: Mapping[str, DataFrame], *, key: str = "tweet_id", row_order: str = ROW_ORDER
) -> DataFrame:
    """Posts of all sources, one row per id, flagged with every entity they came for."""
    merged = merge_duplicates(
        tag_sources(sources), key, list(sources), order=[SOURCE_RANK, row_order]
    )
    return merged.drop(SOURCE_RANK, row_order)


def prepare_posts(
    sources: Mapping[str, DataFrame],
    profiles: LanguageProfiles,
    *,
    key: str = "tweet_id",
    text: str = "tweet",
    created_at: str = "created_at",
    row_order: str = ROW_ORDER,
    language: str = "en",
    dump_path: str | None = None,
) -> DataFrame:
    """Merged posts with a timestamp, a language flag and cleaned text.

    The language is judged on the raw text, before cleaning. With ``dump_path`` the
    result is written there as Parquet, and what is returned reads it back.
    """
    merged = merge_posts(sources, key=key, row_order=row_order)
    timed = merged.withColumn(
        "timestamp",
        F.col(created_at).cast("timestamp")
        if merged.schema[created_at].dataType.typeName().startswith("timestamp")
        else parse_timestamp(created_at),
    )
    flagged = flag_language(timed, profiles, text=text, language=language)
    processed = flagged.withColumn(text, clean_text(text)).withColumnRenamed(text, "textdata")
    if dump_path is None:
        return processed
    write_table(processed, dump_path)
    return read_table(processed.sparkSession, dump_path, processed.schema)


def prepare_articles(
    articles: DataFrame, entities: Sequence[str], *, keep: Sequence[str] = ()
) -> DataFrame:
    """(keep..., textdata, timestamp, mentions_{entity}...) of articles: lowercased title,
    with the description where that names an entity."""
    named = articles.withColumnRenamed("published_at", "timestamp").withColumn(
        "textdata", F.lower(compose_text("title", "description", entities))
    )
    return flag_mentions(named, "textdata", entities).select(
        *keep, "textdata", "timestamp", *[mention(e) for e in entities]
    )
