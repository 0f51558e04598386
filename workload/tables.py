"""Input tables of the engine, derived by Spark from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodline.functions.time import utc_day
from moodline.operators.prepare import flag_mentions
from moodline.schemas import mention
from moodline.sources.files import spread

# Words of the test texts that stand for entities.
ENTITIES = ("with", "was")
LANGUAGES = ("de", "en", "es", "fr")

# Word valences; halves and quarters, so that sums are exact in any order.
VALENCES = {
    "for": 1.0,
    "this": 0.5,
    "by": 0.75,
    "be": 1.75,
    "at": 1.25,
    "that": 0.25,
    "are": -1.25,
    "from": -1.75,
    "on": -0.5,
    "as": -1.0,
    "is": -0.25,
    "it": -0.75,
    "avec": 1.5,
    "pour": -1.5,
    "und": 0.5,
    "mit": -0.5,
    "con": 1.0,
    "para": -1.0,
}
# What the entities themselves count where a text is read as a prompt.
ASPECT_VALENCES = {"with": 1.25, "was": -0.75}
# Phrases of the test texts; some begin, end or hold others, or hold words with a valence.
PHRASES = {
    "of the": 1.25,
    "the and": -1.75,
    "the and attion": 2.25,
    "and the": -0.5,
    "and the of": 0.75,
    "is the": 0.75,
    "that is": -2.0,
    "that is the": 1.5,
    "to the": 0.25,
    "the to": -0.25,
    "attion to thanedble": 1.5,
    "thanedble the": -0.75,
    "the the the the": 0.5,
    "de la": 0.5,
    "la de": -0.75,
    "de la de": 1.0,
    "der der": 0.25,
}
# Words of the test texts that stand for shifting words.
SHIFTING = {
    "intensifiers": ("the", "le"),
    "dampeners": ("of", "de"),
    "negations": ("to", "a"),
    "contrast": "and",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def lexicon(spark: SparkSession, phrases: bool = False) -> DataFrame:
    entries = VALENCES | PHRASES if phrases else VALENCES
    rows = ", ".join(f"('{word}', {value}D)" for word, value in entries.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS lexicon(token, valence)")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts: each takes time, user and likes from an event."""
    events = table(spark, sf_dir, "events")
    users = events.groupBy("user_id").agg(F.min("ts").alias("joined"))
    return (
        documents(spark, sf_dir)
        .withColumn("event_id", F.col("doc_id") * 5)
        .join(events.select("event_id", "ts", "user_id", "value"), "event_id")
        .join(users, "user_id", "left")  # dropped from the plan where "joined" is unused
        .select(
            F.col("doc_id").alias("tweet_id"),
            F.col("text").alias("tweet"),
            (F.col("lang") == "en").alias("is_en"),
            F.col("source").alias("country"),
            F.col("ts").cast("timestamp").alias("created_at"),
            F.floor("value").cast("double").alias("likes"),
            ((F.col("user_id") * 37) % 1000).cast("double").alias("user_followers_count"),
            F.col("joined").cast("timestamp").alias("user_join_date"),
        )
    )


def post_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """One source per entity: the posts that mention it. Posts that mention both are in both."""
    flagged = flag_mentions(posts(spark, sf_dir), "tweet", ENTITIES)
    return {
        e: flagged.filter(F.col(mention(e)) == 1)
        .drop(*[mention(other) for other in ENTITIES])
        .withColumn("row_order", F.col("tweet_id"))
        for e in ENTITIES
    }


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts as articles: the first line is the title, all other lines the description."""
    return posts(spark, sf_dir).select(
        F.col("tweet_id").alias("article_id"),
        F.substring_index("tweet", "\n", 1).alias("title"),
        F.expr("substring(tweet, length(substring_index(tweet, '\n', 1)) + 2)").alias("description"),
        F.col("country").alias("source"),
        F.when(F.col("is_en"), "en").otherwise("other").alias("language"),
        F.col("created_at").alias("published_at"),
    )


def flagged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", F.col("text").alias("textdata"))
    return flag_mentions(docs, "textdata", ENTITIES)


def flagged_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with flags and the columns a processed post carries."""
    named = posts(spark, sf_dir).withColumnsRenamed(
        {"tweet": "textdata", "created_at": "timestamp"}
    )
    return flag_mentions(named, "textdata", ENTITIES)


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as labelled mentions of two candidates."""
    value = F.col("value")
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type").isin("click", "view"))
        .select(
            F.col("ts").alias("timestamp"),
            F.col("event_type").alias("candidate"),
            F.when(value >= 60, "Positive")
            .when(value <= 20, "Negative")
            .otherwise("Neutral")
            .alias("sentiment_label"),
        )
    )


CANDIDATES = ("click", "view")


def labels_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    win = F.when(F.col("value") > 34, 1.0).otherwise(0.0)
    return (
        table(spark, sf_dir, "events")
        .groupBy(utc_day("ts").alias("date"))
        .agg(F.avg(win).alias("p_win"))
    )


def forecast_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a long forecast: day, place (null is the whole country), party, value."""
    party = (
        F.when(F.col("o_orderstatus") == "F", "REP")
        .when(F.col("o_orderstatus") == "O", "DEM")
        .otherwise("IND")
    )
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            utc_day("o_orderdate").cast("string").alias("model_date"),
            F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("state_abb"),
            party.alias("party"),
        )
        .agg((F.avg("o_totalprice") / 1000000).alias("value"))
        .withColumns({"variable": F.lit("electoral college"), "metric": F.lit("p_win")})
    )


def toplines(spark: SparkSession, sf_dir: str) -> DataFrame:
    def share(status: str):
        return F.avg(F.when(F.col("o_orderstatus") == status, 1.0).otherwise(0.0))

    return (
        table(spark, sf_dir, "orders")
        .groupBy(utc_day("o_orderdate").cast("string").alias("modeldate"))
        .agg(share("F").alias("ecwin_inc"), share("O").alias("ecwin_chal"))
    )


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(utc_day("l_shipdate").cast("string").alias("Date (ET)"))
        .agg(
            F.avg("l_discount").alias("Close Share Price"),
            F.avg("l_tax").alias("Average Trade Price"),
        )
    )


def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, discount, p_win): one regressor and a label per day of orders and shipments."""
    prices = (
        table(spark, sf_dir, "orders")
        .groupBy(utc_day("o_orderdate").alias("date"))
        .agg((F.avg("o_totalprice") / 500000).alias("p_win"))
    )
    discounts = (
        table(spark, sf_dir, "lineitem")
        .groupBy(utc_day("l_shipdate").alias("date"))
        .agg((F.avg("l_discount") * 10).alias("discount"))
    )
    return discounts.join(prices, "date")


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, price, tax, p_win): a regressor with signal, one without, and a label per day."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(utc_day("l_shipdate").alias("date"))
        .agg(
            (F.avg("l_extendedprice") / 100000).alias("price"),
            (F.avg("l_tax") * 10).alias("tax"),
            (F.avg(F.col("l_extendedprice") * (1 - F.col("l_discount"))) / 100000).alias("p_win"),
        )
    )
