"""Exact deduplication by a count of filter cells and a Bloom filter, in DataFrame functions only.

The first pass is an exact count: each text's hash falls into a cell, a word and two bits of it,
and every distinct cell of a task is shuffled, as one narrow row. Cells of more than one row make
up a bounded Bloom filter of possibly repeated hashes. The second pass looks every row up in it. Rows that miss it are alone for certain and pass straight through; only the others shuffle, by
the SHA-256 of their text, so a false hit costs time and never a wrong result.

A null text is the empty text; empty texts are copies of each other. Of rows that share the
smallest id of a group (repeated rows), the first in table order stays. Null ids come last.
An empty table gives an empty result. Columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.llm.common import SPACES, numbered, stored_rows, unpacked
from moodline.session import stage

#: The filter's 64-bit words: at most 2^20, so that its broadcast stays below 64 MB at any size.
#: Fuller filters only send more rows through the shuffle.
MIN_WORDS, MAX_WORDS = 1 << 10, 1 << 20


def text_sha256(text: Column) -> Column:
    """Lower-case hex of the text with each run of white space made one space."""
    return F.sha2(F.regexp_replace(text, SPACES, " "), 256)


def _cell(sha: str, words: int) -> tuple[Column, Column]:
    """The filter word of a hash and its two bits in it."""
    h = F.xxhash64(sha)
    bit = [F.shiftrightunsigned(h, n).bitwiseAND(F.lit(63)).cast("int") for n in (40, 48)]
    one = F.lit(1).cast("long")
    mask = F.call_function("shiftleft", one, bit[0]).bitwiseOR(
        F.call_function("shiftleft", one, bit[1])
    )
    return F.pmod(h, F.lit(words)), mask


def _filter_words(rows: int) -> int:
    size = MIN_WORDS
    while size < MAX_WORDS and size * 4 < rows:
        size *= 2
    return size


def repeated_filter(hashes: DataFrame, words: int) -> DataFrame:
    """word, bits: the filter of hashes that may occur more than once.

    Copies fall together within each task before anything is shuffled, so a text that makes up a
    third of all rows is one row per task here.
    """
    word, mask = _cell("sha", words)
    return (
        hashes.groupBy(word.alias("word"), mask.alias("mask"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .groupBy("word")
        .agg(F.bit_or("mask").alias("bits"))
    )


def _probe(hashes: DataFrame, bloom: DataFrame, words: int) -> DataFrame:
    """Adds ``maybe``: whether the row's hash hits the filter."""
    word, mask = _cell("sha", words)
    hit = F.coalesce(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"), F.lit(False))
    return (
        hashes.withColumns({"word": word, "mask": mask})
        .join(F.broadcast(bloom), "word", "left")
        .withColumn("maybe", hit)
        .drop("word", "mask", "bits")
    )


def _groups(hashes: DataFrame, bloom: DataFrame, words: int) -> DataFrame:
    """sha, keep, group_size of texts that do occur more than once."""
    order = F.struct(F.col("id").isNull().alias("last"), "id", "rid")
    return (
        _probe(hashes, bloom, words)
        .filter("maybe")
        .groupBy("sha")
        .agg(F.min(order).alias("keep"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
    )


def _prepared(rows: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, int]:
    hashes = stage(
        rows.select(
            F.col(f"row.`{id_col}`").alias("id"),
            "rid",
            text_sha256(F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))).alias("sha"),
        ),
        "dedup-hashes",
    )
    words = _filter_words(hashes.count())
    return hashes, stage(repeated_filter(hashes, words), "dedup-filter"), words


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The text is read once, for its hash; all else works on rows of some 50 bytes.
    """
    hashes, bloom, words = _prepared(numbered(docs), id_col, text_col)
    groups = stage(_groups(hashes, bloom, words), "dedup-groups")
    looked_up = _probe(hashes, bloom, words)
    suspects = looked_up.filter("maybe").join(groups, "sha", "left")
    alone = looked_up.filter("not maybe")
    one = F.lit(1).cast("long")
    repeated = F.col("group_size").isNotNull()
    return suspects.select(
        F.col("id").alias("doc_id"),
        F.when(repeated, F.col("keep.id")).otherwise(F.col("id")).alias("keep_id"),
        F.coalesce("group_size", one).alias("group_size"),
        F.coalesce(F.col("keep.rid") == F.col("rid"), F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    ).unionByName(
        alone.select(
            F.col("id").alias("doc_id"),
            F.col("id").alias("keep_id"),
            one.alias("group_size"),
            F.lit(True).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns. Rows that miss the filter are not shuffled."""
    rows = stored_rows(docs, "dedup-rows")
    hashes, bloom, words = _prepared(rows, id_col, text_col)
    groups = stage(_groups(hashes, bloom, words), "dedup-groups")
    extra = stage(
        _probe(hashes, bloom, words)
        .filter("maybe")
        .join(groups, "sha")
        .filter(F.col("keep.rid") != F.col("rid"))
        .select("rid"),
        "dedup-extra",
    )
    sha = text_sha256(F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit("")))
    looked_up = _probe(rows.withColumn("sha", sha), bloom, words)
    alone = looked_up.filter("not maybe")
    suspects = looked_up.filter("maybe").join(extra, "rid", "left_anti")
    return unpacked(alone.unionByName(suspects), docs)
