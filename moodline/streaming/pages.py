"""Collecting result pages as they arrive.

Asking for page after page until none is left is, over a folder of pages, a file
stream with the available-now trigger: it takes the pages it has not seen, stops
when there are none, and goes on from there at the next call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from moodline.schemas import RAW_ARTICLES
from moodline.sources.files import page_rows


def stream_pages(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_ARTICLES,
    *,
    max_files: int = 1000,
) -> DataFrame:
    """A stream of the articles on the pages of a folder, a page per file or per line."""
    pages = (
        spark.readStream.option("maxFilesPerTrigger", max_files).text(path, wholetext=True)
    )
    return page_rows(pages, schema)


def collect_pages(
    spark: SparkSession,
    pages: str,
    table: str,
    checkpoint: str,
    schema: T.StructType = RAW_ARTICLES,
    *,
    max_files: int = 1000,
) -> None:
    """Append the articles of all new pages to a Parquet table, each page once.

    ``checkpoint`` remembers the pages already taken: keep it on shared storage.
    """
    query = (
        stream_pages(spark, pages, schema, max_files=max_files)
        .writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
