"""Joining a large table with a lookup table whose size is measured first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 2_000_000
MAX_BYTES = 256 * 1024 * 1024
SALT_BUCKETS = 64


def fits_broadcast(lookup: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Whether a table of scalar columns is proven small, by at most ``max_rows + 1`` rows."""
    text = [f.name for f in lookup.schema.fields if f.dataType.typeName() == "string"]
    size = F.lit(8 * (len(lookup.columns) - len(text)))
    for name in text:
        size = size + F.coalesce(F.octet_length(name), F.lit(0))
    row = (
        lookup.limit(max_rows + 1)
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("size"))
        .first()
    )
    return row["n"] <= max_rows and row["size"] <= max_bytes


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: str,
    *,
    how: str = "inner",
    spread: str | None = None,
    max_rows: int = MAX_ROWS,
    max_bytes: int = MAX_BYTES,
    salt_buckets: int = SALT_BUCKETS,
) -> DataFrame:
    """Join with a lookup table that has unique keys.

    A table proven small is broadcast, so the large side is not shuffled. A larger
    one is joined by shuffle; keys as frequent as common words would then overload
    single tasks, so both sides get a salt: the large side one bucket per row,
    by the hash of ``spread``, and the lookup side a copy per bucket.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    if fits_broadcast(lookup, max_rows, max_bytes):
        return left.join(F.broadcast(lookup), on, how)
    bucket = F.xxhash64(spread if spread is not None else on)
    salted = left.withColumn("_salt", F.pmod(bucket, F.lit(salt_buckets)).cast("int"))
    copies = lookup.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)))
    )
    return salted.join(copies, [on, "_salt"], how).drop("_salt")
