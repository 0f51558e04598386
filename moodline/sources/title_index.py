"""A stored positional index of article titles: searches read the asked words, not all titles.

An index is a folder of two tables. ``articles`` has the articles as they came, numbered by batch and
row. ``postings`` has a row for every word of every title: which row it is in, at what place, and
whether just one blank parts it from the word before. Postings lie in buckets by the word's hash, sorted
by word, so a search opens the buckets of its words only and skips most of what is in them. Phrases
are found by intersecting postings whose places follow one another, and boolean searches by
intersecting rows; articles are read for what is left.

Words and phrases match as ``search_articles`` matches them. More batches can be added; a batch that was
cut off while it was written is not part of the index.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodline.functions.text import WORD_CHARS, mention_pattern
from moodline.session import stage
from moodline.sources.articles import ENTITY_PHRASES, PUBLISHED_AFTER, PUBLISHED_BEFORE, TOPIC_WORDS

BUCKETS = 64
WORD = rf"[{WORD_CHARS}]+"
BATCH, ROW = "_batch", "_row"


def _bucket(token, buckets: int):
    return F.pmod(F.xxhash64(token), F.lit(buckets)).cast("int")


def occurrences(articles: DataFrame, title: str) -> DataFrame:
    """(batch, row, token, place, joined) of every word of every title; a null title has none."""
    lowered = F.lower(F.col(f"`{title}`"))
    tokens, gaps = F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)), F.split(lowered, WORD)
    listed = articles.select(BATCH, ROW, F.posexplode(F.arrays_zip(tokens.alias("token"), gaps.alias("gap"))).alias("place", "at"))
    return listed.select(
        BATCH, ROW, F.col("at.token").alias("token"), "place", (F.col("at.gap") == " ").alias("joined")
    ).filter("token is not null")  # behind the last word there is one more gap


def add_articles(articles: DataFrame, path: str, title: str = "title", buckets: int = BUCKETS) -> str:
    """Add articles as a batch; gives its name. The number of buckets is that of the first batch.

    Articles are written last, so postings without articles, of a batch that was cut off, match nothing.
    """
    batch, root, spark = uuid.uuid4().hex, path.rstrip("/"), articles.sparkSession
    rows = articles.withColumns({BATCH: F.lit(batch), ROW: F.monotonically_increasing_id()})
    numbered = stage(rows, "index-articles")  # once, so both tables have the same numbers
    buckets = _buckets(spark, root) or buckets
    found = occurrences(numbered, title).withColumns({"bucket": _bucket("token", buckets), "buckets": F.lit(buckets)})
    (
        found.hint("rebalance", "bucket")
        .sortWithinPartitions("bucket", "token")
        .write.mode("append")
        .partitionBy("buckets", "bucket")
        .parquet(f"{root}/postings")
    )
    numbered.write.mode("append").parquet(f"{root}/articles")
    return batch


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _buckets(spark: SparkSession, root: str) -> int | None:
    postings = _read(spark, f"{root}/postings")
    # a folder's name: no file is read
    row = postings.select(F.max("buckets")).first() if postings is not None else None
    return row[0] if row else None


def _terms(groups: Sequence[Sequence[str]]) -> list[tuple[int, int, int, int, str]]:
    """(group, term, words of the term, place of a word in it, the word)."""
    out, term = [], 0
    for group, terms in enumerate(groups):
        for text in terms:
            mention_pattern(text)  # raises for what is no word or phrase
            words = text.lower().split(" ")
            if "" in words:
                raise ValueError(f"more than one blank between words: {text!r}")
            out += [(group, term, len(words), k, w) for k, w in enumerate(words)]
            term += 1
    return out


def asked_postings(spark: SparkSession, path: str, tokens: Sequence[str]) -> DataFrame:
    """The postings of some words; other buckets are not opened."""
    root = path.rstrip("/")
    buckets = _buckets(spark, root)
    postings = spark.read.parquet(f"{root}/postings")
    shown = spark.createDataFrame([(t,) for t in tokens], "token string").select(_bucket("token", buckets or 1))
    wanted = sorted({r[0] for r in shown.collect()})
    return postings.filter(F.col("bucket").isin(wanted) & F.col("token").isin(list(tokens)))


def matching_rows(
    spark: SparkSession, path: str, all_of: Sequence[Sequence[str]], none_of: Sequence[str] = ()
) -> DataFrame:
    """(batch, row) of titles that have a term of each group of ``all_of`` and none of ``none_of``."""
    groups = [*all_of, *([none_of] if none_of else [])]
    terms = _terms(groups)
    asked = spark.createDataFrame(terms, "grp int, term int, size int, k int, token string")
    # the words of one search: a handful of rows
    found = asked_postings(spark, path, sorted({t[-1] for t in terms})).join(F.broadcast(asked), "token")
    in_place = found.filter((F.col("k") == 0) | F.col("joined")).select(
        BATCH, ROW, "grp", "term", "size", (F.col("place") - F.col("k")).alias("start")
    )
    whole = in_place.groupBy(BATCH, ROW, "grp", "term", "size", "start").count().filter("count = size")
    hits = whole.groupBy(BATCH, ROW).agg(F.collect_set("grp").alias("groups"))
    wanted = F.array(*[F.lit(g) for g in range(len(all_of))]).cast("array<int>")
    kept = hits.filter(F.size(F.array_except(wanted, "groups")) == 0)
    if none_of:
        kept = kept.filter(~F.array_contains("groups", len(all_of)))
    return kept.select(BATCH, ROW)


def search_index(
    spark: SparkSession,
    path: str,
    *,
    words: Sequence[str] = TOPIC_WORDS,
    phrases: Sequence[str] = ENTITY_PHRASES,
    none_of: Sequence[str] = (),
    after: date | datetime = PUBLISHED_AFTER,
    before: date | datetime = PUBLISHED_BEFORE,
    equals: dict[str, str] | None = None,
    published_at: str = "published_at",
) -> DataFrame:
    """The rows ``search_articles`` finds, less those whose title has a term of ``none_of``."""
    if not words or not phrases:
        raise ValueError("a search needs words and phrases")
    articles = spark.read.parquet(f"{path.rstrip('/')}/articles")
    for column, value in (equals or {}).items():
        articles = articles.filter(F.col(f"`{column}`") == value)
    at = F.col(f"`{published_at}`")
    dated = articles.filter((at >= F.lit(after)) & (at < F.lit(before)))
    rows = matching_rows(spark, path, [words, phrases], none_of)
    return dated.join(rows, [BATCH, ROW], "left_semi").drop(BATCH, ROW)
