"""Selecting articles from a table, as a search for title words, phrases and dates does."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.functions.text import mention_pattern

# The search of the news corpus.
TOPIC_WORDS = ("president", "presidential", "election", "campaign")
ENTITY_PHRASES = ("kamala harris", "donald trump")
PUBLISHED_AFTER, PUBLISHED_BEFORE = date(2024, 1, 1), date(2024, 11, 5)
PAGE_SIZE = 25  # of a result page


def _any_of(text: Column, phrases: Sequence[str]) -> Column:
    hits = [F.coalesce(text.rlike(mention_pattern(p)), F.lit(False)) for p in phrases]
    return reduce(lambda a, b: a | b, hits)


def search_articles(
    articles: DataFrame,
    *,
    words: Sequence[str] = TOPIC_WORDS,
    phrases: Sequence[str] = ENTITY_PHRASES,
    after: date | datetime = PUBLISHED_AFTER,
    before: date | datetime = PUBLISHED_BEFORE,
    equals: dict[str, str] | None = None,
    title: str = "title",
    published_at: str = "published_at",
) -> DataFrame:
    """Articles whose title has one of the words and one of the phrases, in no order.

    ``equals`` holds column values to match (language, country).
    """
    lowered = F.lower(title)
    hits = articles
    for column, value in (equals or {}).items():
        hits = hits.filter(F.col(column) == value)
    hits = hits.filter((F.col(published_at) >= F.lit(after)) & (F.col(published_at) < F.lit(before)))
    return hits.filter(_any_of(lowered, words) & _any_of(lowered, phrases))
