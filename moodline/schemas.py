"""Explicit schemas of the input and stage tables. Nothing is inferred on read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

# Column names and types of the interchange files.

RAW_POSTS = T.StructType(
    [
        T.StructField("created_at", T.TimestampType()),
        T.StructField("tweet_id", T.LongType()),
        T.StructField("tweet", T.StringType()),
        T.StructField("likes", T.DoubleType()),
        T.StructField("user_join_date", T.TimestampType()),
        T.StructField("user_followers_count", T.DoubleType()),
        T.StructField("country", T.StringType()),
    ]
)

RAW_ARTICLES = T.StructType(
    [
        T.StructField("uuid", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
    ]
)

TOPLINES = T.StructType(
    [
        T.StructField("modeldate", T.StringType()),
        T.StructField("ecwin_inc", T.DoubleType()),
        T.StructField("ecwin_chal", T.DoubleType()),
    ]
)

FORECAST_LONG = T.StructType(
    [
        T.StructField("model_date", T.StringType()),
        T.StructField("state_abb", T.StringType()),
        T.StructField("variable", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("party", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

MARKET_PRICES = T.StructType(
    [
        T.StructField("Date (ET)", T.StringType()),
        T.StructField("Close Share Price", T.DoubleType()),
        T.StructField("Average Trade Price", T.DoubleType()),
    ]
)

LEXICON = T.StructType(
    [
        T.StructField("token", T.StringType(), False),
        T.StructField("valence", T.DoubleType(), False),
    ]
)


def mention(entity: str) -> str:
    return f"mentions_{entity}"


def label_of(entity: str) -> str:
    return f"{entity}_sentiment_label"


def score_of(entity: str) -> str:
    return f"{entity}_sentiment_score"


def processed_news(entities: Sequence[str]) -> T.StructType:
    """Record of the processed-news file: text, epoch milliseconds, one flag per entity."""
    return T.StructType(
        [
            T.StructField("textdata", T.StringType()),
            T.StructField("timestamp", T.LongType()),
            *[T.StructField(mention(e), T.IntegerType()) for e in entities],
        ]
    )
