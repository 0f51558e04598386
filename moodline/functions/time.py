"""Time columns. Days are UTC days: the session time zone is pinned to UTC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from moodline.functions.columns import as_column

MICROS_PER_DAY = 86_400_000_000


def parse_timestamp(value: Column | str, fmt: str | None = None) -> Column:
    """Text to timestamp; text that does not parse becomes null."""
    value = as_column(value).cast("string")
    return F.try_to_timestamp(value, F.lit(fmt)) if fmt else F.try_to_timestamp(value)


def parse_date(value: Column | str, formats: Sequence[str] = ()) -> Column:
    """Text to date: ISO first, then the first of ``formats`` that fits, else null."""
    value = as_column(value).cast("string")
    parsed = [F.try_to_timestamp(value), *[F.try_to_timestamp(value, F.lit(f)) for f in formats]]
    return F.coalesce(*parsed).cast("date")


def from_epoch_ms(value: Column | str) -> Column:
    return F.timestamp_millis(as_column(value).cast("long"))


def to_epoch_ms(value: Column | str) -> Column:
    return F.unix_millis(as_column(value).cast("timestamp"))


def utc_day(value: Column | str) -> Column:
    return F.to_date(as_column(value))


def account_age_days(at: Column | str, joined: Column | str) -> Column:
    """Whole days between two instants, rounded down (6 hours before joining is -1).

    Elapsed time, not calendar days: two hours across midnight are 0 days.
    """
    elapsed = F.unix_micros(as_column(at).cast("timestamp")) - F.unix_micros(
        as_column(joined).cast("timestamp")
    )
    return F.floor(elapsed / F.lit(MICROS_PER_DAY)).cast("long")
