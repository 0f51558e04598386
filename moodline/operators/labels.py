"""Daily win-probability series: (date, p_win, p_lose) from forecasts or market prices."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodline.functions.measures import complement
from moodline.functions.time import parse_date
from moodline.operators.daily import pivot_entities

DATE_FORMATS = ("M/d/yyyy", "M/d/yy")

# Columns and codes of the published probability tables.
MARKET_DATE = "Date (ET)"
TRADE_COLUMNS = {"close": "Close Share Price", "average": "Average Trade Price"}
TOPLINE_COLUMNS = {"modeldate": "date", "ecwin_inc": "p_win", "ecwin_chal": "p_lose"}
FORECAST_SLICE = {"variable": "electoral college", "metric": "p_win"}
WINNING_PARTY, LOSING_PARTIES = "REP", ("DEM", "IND")
FORECAST, MARKET = "538", "PredictIt"
TRAIN, TEST = "train", "test"


def topline_labels(toplines: DataFrame, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Forecast with one row per day: win and lose probability are its own columns."""
    named = toplines.select(*TOPLINE_COLUMNS).withColumnsRenamed(TOPLINE_COLUMNS)
    return named.withColumn("date", parse_date("date", formats))


def forecast_labels(forecast: DataFrame, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Forecast with one row per day, place, measure and party: the national win share."""
    parties = [WINNING_PARTY, *LOSING_PARTIES]
    national = forecast.filter(F.col("state_abb").isNull())
    for column, value in FORECAST_SLICE.items():
        national = national.filter(F.col(column) == value)
    wide = pivot_entities(
        national.withColumn("date", parse_date("model_date", formats)),
        parties,
        ["value"],
        candidate="party",
    ).fillna(0.0, subset=parties)
    lose = sum((F.col(p) for p in LOSING_PARTIES[1:]), F.col(LOSING_PARTIES[0]))
    return wide.select("date", F.col(WINNING_PARTY).alias("p_win"), lose.alias("p_lose"))


def market_labels(
    prices: DataFrame, trade_type: str = "close", formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """Share price of the win contract as win probability."""
    if trade_type not in TRADE_COLUMNS:
        raise ValueError(f"unknown trade type: {trade_type!r}")
    price = F.col(f"`{TRADE_COLUMNS[trade_type]}`")
    return prices.select(
        parse_date(F.col(f"`{MARKET_DATE}`"), formats).alias("date"),
        price.alias("p_win"),
        complement(price).alias("p_lose"),
    )


@dataclass(frozen=True)
class LabelTables:
    """The raw label tables of one split; only the one asked for is read."""

    forecast: DataFrame | None = None
    market: DataFrame | None = None


def label_series(
    tables: LabelTables,
    label_type: str = FORECAST,
    trade_type: str = "close",
    *,
    split: str = TRAIN,
    market_only: bool = False,
) -> DataFrame:
    """The series for a label type; the two splits publish their forecast differently."""
    providers = {
        (TRAIN, FORECAST): lambda: topline_labels(tables.forecast),
        (TEST, FORECAST): lambda: forecast_labels(tables.forecast),
        (TRAIN, MARKET): lambda: market_labels(tables.market, trade_type),
        (TEST, MARKET): lambda: market_labels(tables.market, trade_type),
    }
    chosen = (split, MARKET if market_only else label_type)
    if chosen not in providers:
        raise ValueError(f"unknown split or label type: {split!r}, {label_type!r}")
    return providers[chosen]()


def join_labels(
    features: DataFrame, labels: DataFrame, *, day: str = "date", on_duplicate: str = "keep"
) -> DataFrame:
    """Feature rows that have a label on their day, with its win probability.

    A day with two labels yields two rows, or an error if ``on_duplicate`` says so.
    Both sides hold about one row per day; adaptive execution broadcasts the smaller
    one from its measured size, so no hint is given.
    """
    if on_duplicate not in ("keep", "error"):
        raise ValueError(f"unknown duplicate rule: {on_duplicate!r}")
    series = labels.select(F.col("date").cast("date").alias(day), "p_win")
    if on_duplicate == "error":
        twice = F.raise_error(F.concat(F.lit("more than one label on "), F.col(day)))
        series = series.groupBy(day).agg(
            F.when(F.count(F.lit(1)) > 1, twice.cast("double")).otherwise(F.max("p_win")).alias("p_win")
        )
    return features.join(series, day, "inner")
