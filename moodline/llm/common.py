"""What the operators of this subpackage share: table access, row numbers, word splitting."""

from __future__ import annotations

import zlib

from pyspark import SparkContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodline.session import stage

#: White space and words as the operators define them: space and the controls 9 to 13 only.
SPACES = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str) -> Column:
    """The whole text; null is empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def numbered(docs: DataFrame) -> DataFrame:
    """Every row as ``row`` (a struct of all its columns) with its number ``rid``.

    Whatever the columns are called, nothing else can clash with them. Numbers hold for this
    scan only: splits, and numbers with them, follow the cores at hand when a scan is planned.
    What needs the rows twice takes ``stored_rows``.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(whole, F.monotonically_increasing_id().alias("rid"))


def stored_rows(docs: DataFrame, name: str) -> DataFrame:
    """``numbered`` rows, written once: each pass over them meets the same numbers."""
    return stage(numbered(docs), name)


def unpacked(rows: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``like`` back out of ``row``."""
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in like.columns])


class Parcel:
    """A broadcast of objects whose classes travel with them: workers may lack this package."""

    def __init__(self, context: SparkContext, value: object):
        self.sent, self.held = context.broadcast(cloudpickle.dumps(value)), None

    def __getstate__(self) -> dict:
        return {"sent": self.sent, "held": None}

    @property
    def value(self):
        if self.held is None:
            self.held = cloudpickle.loads(self.sent.value)
        return self.held


def words(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case. Bytes split at space and controls 9 to 13, nothing else."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def fold(doc_id: int | None, folds: int) -> int:
    """Remainder of crc32 of the id as text; a null id counts as empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


def fold_of(column: str, folds: int) -> Column:
    """The same in SQL."""
    return (F.crc32(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))) % folds).cast("int")
