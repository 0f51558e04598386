"""One query per operator, over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodline.functions import measures, text, time
from moodline.operators import arimax, aspects, boosting, daily, evaluation, labels, language, lexicon, models, moments, scoring, stored
from moodline.operators.prepare import propagate_flags, quality_filter, tag_sources
from moodline.plans import features, preparation, run
from moodline.schemas import TOPLINES, label_of, mention, processed_news, score_of
from moodline.session import configure, stage, stage_path
from moodline.sources import articles as article_search
from moodline.sources import days, files, sinks, title_index
from moodline.streaming import merging
from moodline.streaming.pages import collect_pages
from workload import tables as t
from workload.tables import CANDIDATES, ENTITIES

Query = Callable[[SparkSession, str], DataFrame]


# Averages of decimal values can lie exactly between two roundings, where the last bit
# of a sum would decide; a nudge far below the last digit takes them off it.
OFF_TIES = 1e-10


FORECAST_FROM = date(2001, 5, 1)


def report(df: DataFrame) -> DataFrame:
    """Results in types both engines print alike: long, double of 6 digits, string."""
    shown = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, T.DoubleType | T.FloatType):
            column = F.round(column.cast("double") + OFF_TIES, 6)
        elif isinstance(kind, T.IntegralType | T.BooleanType):
            column = column.cast("long")
        elif isinstance(kind, T.TimestampType):
            column = F.unix_micros(column)
        else:
            column = column.cast("string")
        shown.append(column.alias(field.name))
    return df.select(*shown)


# --- text -----------------------------------------------------------------------------


def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return t.documents(spark, sf).select("doc_id", text.clean_text("text").alias("cleaned"))


def mention_flags(spark: SparkSession, sf: str) -> DataFrame:
    return t.flagged_documents(spark, sf).drop("textdata")


def compose_text(spark: SparkSession, sf: str) -> DataFrame:
    return t.articles(spark, sf).select(
        "article_id", text.compose_text("title", "description", ENTITIES).alias("composed")
    )


def prompt_template(spark: SparkSession, sf: str) -> DataFrame:
    return t.documents(spark, sf).select(
        "doc_id", text.aspect_prompt("text", ENTITIES[0]).alias("prompt")
    )


def search_articles(spark: SparkSession, sf: str) -> DataFrame:
    return article_search.search_articles(
        t.articles(spark, sf),
        words=("for", "is", "that"),
        phrases=("of the", "and the", "the", "with"),
        after=date(2024, 1, 2),
        before=date(2024, 1, 12),
        equals={"language": "en"},
    ).select("article_id", "title", "published_at")


def _title_index(spark: SparkSession, sf: str) -> str:
    path = stage_path(spark, "title-index")
    title_index.add_articles(t.articles(spark, sf), path)
    return path


SEARCHED = {"after": date(2024, 1, 2), "before": date(2024, 1, 12), "equals": {"language": "en"}}


def search_index(spark: SparkSession, sf: str) -> DataFrame:
    """The same search through a stored index of the titles' words."""
    found = title_index.search_index(
        spark,
        _title_index(spark, sf),
        words=("for", "is", "that"),
        phrases=("of the", "and the", "the", "with"),
        **SEARCHED,
    )
    return found.select("article_id", "title", "published_at")


def search_index_without(spark: SparkSession, sf: str) -> DataFrame:
    """Titles with a word and a phrase, and without others."""
    found = title_index.search_index(
        spark, _title_index(spark, sf), words=("the", "and"), phrases=("of the", "is"), none_of=("to the", "in"), **SEARCHED
    )
    return found.select("article_id", "title", "published_at")


# --- preparation ----------------------------------------------------------------------


def tag_union_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return preparation.merge_posts(t.post_sources(spark, sf)).drop("is_en")


def flag_propagation(spark: SparkSession, sf: str) -> DataFrame:
    tagged = tag_sources(t.post_sources(spark, sf))
    return propagate_flags(tagged, "tweet_id", ENTITIES).select(
        "tweet_id", "source_rank", *[mention(e) for e in ENTITIES]
    )


def account_age_filter(spark: SparkSession, sf: str) -> DataFrame:
    return quality_filter(
        t.posts(spark, sf),
        min_account_age=2,
        min_followers=100,
        min_likes=5,
        at="created_at",
    ).select("tweet_id", "account_age", "likes", "user_followers_count")


def epoch_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    ms = t.table(spark, sf, "events").select("event_id", time.to_epoch_ms("ts").alias("ms"))
    return ms.select(
        "event_id", "ms", time.utc_day(time.from_epoch_ms("ms")).alias("day")
    )


def parsed_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    """Times written in two layouts, some of them broken, read back."""
    events = t.table(spark, sf, "events")
    long = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    short = F.date_format("ts", "M/d/yyyy H:mm")
    broken = F.col("event_id") % 7 == 0
    written = events.select(
        "event_id",
        F.when(broken, F.concat(long, F.lit(" or so"))).otherwise(long).alias("long"),
        F.when(broken, "13/45/2024 7:00").otherwise(short).alias("short"),
    )
    return written.select(
        "event_id",
        time.parse_timestamp("long").alias("at"),
        time.parse_timestamp("short", "M/d/yyyy H:mm").alias("at_minute"),
    )


def parsed_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates written in two formats, read back by one parser."""
    orders = t.table(spark, sf, "orders")
    written = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "M/d/yyyy")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return (
        orders.select("o_orderkey", written.alias("written"))
        .select(
            "o_orderkey", time.parse_date("written", labels.DATE_FORMATS).alias("day")
        )
    )


def prepare_posts(spark: SparkSession, sf: str) -> DataFrame:
    docs = t.documents(spark, sf)
    profiles = language.build_profiles(docs, "text", "lang", t.LANGUAGES)
    sources = {e: df.drop("is_en") for e, df in t.post_sources(spark, sf).items()}
    return preparation.prepare_posts(sources, profiles).select(
        "tweet_id", "textdata", "timestamp", "is_en", *[mention(e) for e in ENTITIES]
    )


def prepare_articles(spark: SparkSession, sf: str) -> DataFrame:
    return preparation.prepare_articles(t.articles(spark, sf), ENTITIES, keep=["article_id"])


# --- language -------------------------------------------------------------------------


def language_profiles(spark: SparkSession, sf: str) -> DataFrame:
    docs = t.documents(spark, sf)
    return language.profile_table(language.build_profiles(docs, "text", "lang", t.LANGUAGES))


def language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = t.documents(spark, sf)
    profiles = language.build_profiles(docs, "text", "lang", t.LANGUAGES)
    return language.flag_language(docs, profiles, text="text").select(
        "doc_id", "is_en"
    )


# --- sentiment ------------------------------------------------------------------------


def language_id_by_join(spark: SparkSession, sf: str) -> DataFrame:
    """The same by join, which profiles of any size can take."""
    docs = t.documents(spark, sf)
    profiles = language.build_profiles(docs, "text", "lang", t.LANGUAGES)
    return language.detect_by_join(docs, profiles, "doc_id", "text")


def _scored_texts(spark: SparkSession, sf: str, scorer: lexicon.Scorer) -> DataFrame:
    docs = t.documents(spark, sf)
    return lexicon.score_rows(docs.select("doc_id", "text"), scorer, "text").drop("text")


def lexicon_score(spark: SparkSession, sf: str) -> DataFrame:
    return _scored_texts(spark, sf, lexicon.compound_scorer(t.lexicon(spark), None))


def lexicon_score_shifters(spark: SparkSession, sf: str) -> DataFrame:
    shifters = lexicon.Shifters(**t.SHIFTING)
    return _scored_texts(spark, sf, lexicon.compound_scorer(t.lexicon(spark), shifters))


def phrase_score(spark: SparkSession, sf: str) -> DataFrame:
    """Words and phrases, found in place by an automaton."""
    return _scored_texts(spark, sf, lexicon.compound_scorer(t.lexicon(spark, phrases=True)))


def phrase_score_by_join(spark: SparkSession, sf: str) -> DataFrame:
    """The same as for a table too large for the tasks: by join with the grams of the texts."""
    return _scored_texts(spark, sf, lexicon.LexiconScorer(t.lexicon(spark, phrases=True), most=0))


def phrase_score_shifters(spark: SparkSession, sf: str) -> DataFrame:
    """Words and phrases, shifted by the words before them."""
    shifters = lexicon.Shifters(**t.SHIFTING)
    return _scored_texts(spark, sf, lexicon.compound_scorer(t.lexicon(spark, phrases=True), shifters))


def phrase_polarity(spark: SparkSession, sf: str) -> DataFrame:
    return _scored_texts(spark, sf, lexicon.polarity_scorer(t.lexicon(spark, phrases=True)))


def lexicon_score_by_join(spark: SparkSession, sf: str) -> DataFrame:
    """Shifted words by join, as for a table too large for the tasks."""
    shifters = lexicon.Shifters(**t.SHIFTING)
    return _scored_texts(spark, sf, lexicon.LexiconScorer(t.lexicon(spark), shifters=shifters, most=0))


def mean_polarity(spark: SparkSession, sf: str) -> DataFrame:
    return _scored_texts(spark, sf, lexicon.polarity_scorer(t.lexicon(spark)))


def _scored_documents(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score_mentions(
        t.flagged_documents(spark, sf),
        lexicon.compound_scorer(t.lexicon(spark), None),
        ENTITIES,
    )


def sentiment_label(spark: SparkSession, sf: str) -> DataFrame:
    return _scored_documents(spark, sf).select(
        "doc_id",
        *[mention(e) for e in ENTITIES],
        *[score_of(e) for e in ENTITIES],
        *[label_of(e) for e in ENTITIES],
    )


def softmax_label(spark: SparkSession, sf: str) -> DataFrame:
    """The three thirds of each vector, summed, as logits of the three classes."""
    third = F.floor(F.size("embedding") / 3).cast("int")

    def total(start, length):
        part = F.slice("embedding", start, length)
        return F.aggregate(part, F.lit(0.0), lambda a, x: a + x.cast("double"))

    logits = F.array(
        total(F.lit(1), third),
        total(third + 1, third),
        total(third * 2 + 1, F.size("embedding") - third * 2),
    )
    scored = t.table(spark, sf, "embeddings").select("vec_id", logits.alias("logits"))
    shares = scored.withColumn("p", measures.softmax("logits"))
    return shares.select(
        "vec_id",
        *[F.col("p")[i].alias(f"p_{name}") for i, name in enumerate(measures.CLASS_LABELS)],
        measures.top_label("p").alias("sentiment_label"),
    )


def aspect_batch(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.label_aspects(
        t.flagged_documents(spark, sf), scoring.LexiconAspectScorer(t.VALENCES), ENTITIES
    ).select("doc_id", *[label_of(e) for e in ENTITIES])


def aspect_prompt(spark: SparkSession, sf: str) -> DataFrame:
    """The scorer reads prompts, which hold the aspect a second time; aspects have valences here."""
    scorer = scoring.LexiconAspectScorer(t.VALENCES | t.ASPECT_VALENCES)
    out = scoring.label_aspects(t.flagged_documents(spark, sf), scorer, ENTITIES, prompt=True)
    return out.select("doc_id", *[label_of(e) for e in ENTITIES])


def aspect_model(spark: SparkSession, sf: str) -> DataFrame:
    """A model fitted on four fifths of the labelled mentions, applied to all."""
    docs = t.flagged_documents(spark, sf)
    marks = t.table(spark, sf, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    learn = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    label = F.when(F.col("toxic") == 1, 0).otherwise(F.col("quality") + 1)
    model = aspects.train_aspect_model(docs.join(marks.filter(learn), "doc_id"), ENTITIES, label)
    out = scoring.label_aspects(docs, model, ENTITIES)
    return out.select("doc_id", (~learn).alias("held_out"), *[label_of(e) for e in ENTITIES])


def unpivot_entities(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.long_by_entity(_scored_documents(spark, sf), ENTITIES, ["doc_id"])


def entity_summary(spark: SparkSession, sf: str) -> DataFrame:
    return daily.entity_summary(_scored_documents(spark, sf), ENTITIES)


def label_counts(spark: SparkSession, sf: str) -> DataFrame:
    return daily.label_counts(_scored_documents(spark, sf), ENTITIES[0])


# --- daily ----------------------------------------------------------------------------


def _ratios(spark: SparkSession, sf: str) -> DataFrame:
    return daily.daily_ratio_long(daily.with_day(t.signals(spark, sf)), CANDIDATES)


def daily_ratio_long(spark: SparkSession, sf: str) -> DataFrame:
    return _ratios(spark, sf)


def daily_ratio_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return daily.pivot_entities(_ratios(spark, sf), CANDIDATES, ["ratio"])


def daily_ratio_one(spark: SparkSession, sf: str) -> DataFrame:
    rows = t.signals(spark, sf).filter(F.col("candidate") == CANDIDATES[0])
    return daily.daily_ratio_one(daily.with_day(rows))


def _scored_posts(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.score_mentions(
        t.flagged_posts(spark, sf),
        lexicon.compound_scorer(t.lexicon(spark), None),
        ENTITIES,
    )


def daily_ratio_wide(spark: SparkSession, sf: str) -> DataFrame:
    return daily.daily_ratio_wide(daily.with_day(_scored_posts(spark, sf)), ENTITIES)


def daily_ratio_wide_mentions(spark: SparkSession, sf: str) -> DataFrame:
    return daily.daily_ratio_wide(
        daily.with_day(_scored_posts(spark, sf)), ENTITIES, mentions_only=True
    )


def daily_mean(spark: SparkSession, sf: str) -> DataFrame:
    return daily.daily_mean(daily.with_day(t.signals(spark, sf)), CANDIDATES)


def candidate_indicator(spark: SparkSession, sf: str) -> DataFrame:
    """Label indicator of every event, and whether it is about the first candidate."""
    return t.table(spark, sf, "events").select(
        "event_id",
        measures.entity_indicator("event_type", CANDIDATES[0]).alias("about"),
        measures.label_indicator(
            F.when(F.col("value") >= 60, "Positive").when(F.col("value") <= 20, "negative")
        ).alias("indicator"),
    )


def rolling_mean(spark: SparkSession, sf: str) -> DataFrame:
    return _ratios(spark, sf).select(
        "date",
        "candidate",
        daily.trailing_mean("ratio", ["date", "candidate"]).alias("rolling"),
    )


def rolling_mean_per_entity(spark: SparkSession, sf: str) -> DataFrame:
    return _ratios(spark, sf).select(
        "date",
        "candidate",
        daily.trailing_mean("ratio", ["date"], per=["candidate"]).alias("rolling"),
    )


def softsign_measures(spark: SparkSession, sf: str) -> DataFrame:
    """Softsign, complement and binary cut of the daily ratios."""
    return _ratios(spark, sf).select(
        "date",
        "candidate",
        measures.softsign("ratio").alias("softsign"),
        measures.complement("ratio").alias("complement"),
        measures.binarise("ratio", -0.2).alias("above"),
    )


# --- labels and features --------------------------------------------------------------


def forecast_labels(spark: SparkSession, sf: str) -> DataFrame:
    return labels.forecast_labels(t.forecast_long(spark, sf))


def topline_labels(spark: SparkSession, sf: str) -> DataFrame:
    return labels.topline_labels(t.toplines(spark, sf))


def market_labels_close(spark: SparkSession, sf: str) -> DataFrame:
    return labels.market_labels(t.market(spark, sf), "close")


def market_labels_average(spark: SparkSession, sf: str) -> DataFrame:
    return labels.market_labels(t.market(spark, sf), "average")


def features_two_ratios(spark: SparkSession, sf: str) -> DataFrame:
    return features.build_features(
        t.signals(spark, sf), t.labels_daily(spark, sf), CANDIDATES, features.TWO_RATIOS
    )


def features_one_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return features.build_features(
        t.signals(spark, sf), t.labels_daily(spark, sf), CANDIDATES, features.ONE_RATIO
    )


def news_two_ratios(spark: SparkSession, sf: str) -> DataFrame:
    return features.build_features(
        _scored_posts(spark, sf),
        t.labels_daily(spark, sf),
        ENTITIES,
        features.TWO_RATIOS,
        split="test",
    )


def news_one_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return features.build_features(
        _scored_posts(spark, sf),
        t.labels_daily(spark, sf),
        ENTITIES,
        features.ONE_RATIO,
        split="test",
    )


def enhanced_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = scoring.long_by_entity(
        _scored_posts(spark, sf),
        ENTITIES,
        ["timestamp", "is_en", "likes", "user_join_date", "user_followers_count"],
    )
    return features.build_features(
        rows,
        t.labels_daily(spark, sf),
        ENTITIES,
        features.ENHANCED,
        min_account_age=0,
        min_followers=5,
        min_likes=5,
    )


# --- models ---------------------------------------------------------------------------


def _signal_features(spark: SparkSession, sf: str) -> DataFrame:
    return stage(features_two_ratios(spark, sf), "features")


def _series(spark: SparkSession, sf: str) -> DataFrame:
    return stage(t.daily_series(spark, sf), "series")


def _params(fit: models.Fit) -> DataFrame:
    return fit.params().withColumn("r2", F.lit(fit.r2))


def ols_no_intercept(spark: SparkSession, sf: str) -> DataFrame:
    return _params(models.fit_model(_signal_features(spark, sf), "OLS no intercept"))


def linear_fit(spark: SparkSession, sf: str) -> DataFrame:
    return _params(models.fit_model(_series(spark, sf), "Linear Regression"))


def ridge_fit(spark: SparkSession, sf: str) -> DataFrame:
    return _params(models.fit_model(_series(spark, sf), "Ridge", alpha=2.0))


def lasso_fit(spark: SparkSession, sf: str) -> DataFrame:
    return _params(models.fit_model(_series(spark, sf), "Lasso", alpha=0.0005))


def _sales(spark: SparkSession, sf: str) -> DataFrame:
    return stage(t.daily_sales(spark, sf), "sales")


def linear_fit_two(spark: SparkSession, sf: str) -> DataFrame:
    return _params(models.fit_model(_sales(spark, sf), "Linear Regression"))


def ridge_fit_two(spark: SparkSession, sf: str) -> DataFrame:
    return _params(models.fit_model(_sales(spark, sf), "Ridge", alpha=2.0))


def lasso_fit_two(spark: SparkSession, sf: str) -> DataFrame:
    """A penalty that keeps the price and drops the tax."""
    return _params(models.fit_model(_sales(spark, sf), "Lasso", alpha=0.0002))


def penalty_path(spark: SparkSession, sf: str) -> DataFrame:
    """Ridge and lasso with a path of penalties for two labels, from one pass."""
    sales = _sales(spark, sf).withColumn("p_lose", 1 - F.col("p_win"))
    penalties = {"Ridge": [0.0, 0.5, 2.0, 8.0], "Lasso": [0.0, 0.0001, 0.0002, 0.001, 0.01]}
    return moments.penalty_path(sales, ["p_win", "p_lose"], ["price", "tax"], penalties)


def rolling_target_fit(spark: SparkSession, sf: str) -> DataFrame:
    """A model of the label's trailing mean; the label itself is no feature."""
    rolled = t.daily_sales(spark, sf).withColumn("p_win_rolling", daily.trailing_mean("p_win", ["date"]))
    return _params(models.fit_model(stage(rolled, "sales-rolled"), "Linear Regression", rolling=True))


def gbt_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of 20, 50 and 100 trees."""
    series = _series(spark, sf)
    fits = [models.fit_model(series, "Gradient Boosting", n_estimators=n, max_depth=2) for n in (20, 50, 100)]
    return reduce(
        DataFrame.unionAll,
        [
            evaluation.evaluate(fit.predictions, fit.label).select(F.lit(n).alias("trees"), "*")
            for n, fit in zip((20, 50, 100), fits, strict=True)
        ],
    )


def gbt_stump(spark: SparkSession, sf: str) -> DataFrame:
    """The first split over all line items, and the means of its sides."""
    items = t.table(spark, sf, "lineitem").select(
        (F.col("l_extendedprice") / 100000).alias("y"), "l_discount", "l_quantity", "l_tax"
    )
    names = ["l_discount", "l_quantity", "l_tax"]
    model = boosting.fit(items, "y", names, trees=1, depth=1, step=1.0)
    schema = "feature string, threshold double, below double, above double"
    return spark.createDataFrame([boosting.first_split(model, names)], schema)


def arimax_fit(spark: SparkSession, sf: str) -> DataFrame:
    return models.fit_model(_series(spark, sf), "SARIMAX").params()


def _supplier_series(spark: SparkSession, sf: str) -> DataFrame:
    """Per supplier and month, with the months that have line items: mean price and mean discount."""
    month = F.date_trunc("month", F.col("l_shipdate")).cast("date")
    return t.table(spark, sf, "lineitem").groupBy("l_suppkey", month.alias("month")).agg(
        (F.avg("l_extendedprice") / 100000).alias("price"), (F.avg("l_discount") * 10).alias("discount")
    )


def arimax_series(spark: SparkSession, sf: str) -> DataFrame:
    """A likelihood fit for each supplier."""
    return arimax.fit_series(_supplier_series(spark, sf), ["l_suppkey"], "price", ["discount"], "month")


def arimax_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """The last half year of each supplier forecast from all before it."""
    series = _supplier_series(spark, sf)
    known = series.withColumn("known", F.when(F.col("month") < F.lit(FORECAST_FROM), F.col("price")))
    out = arimax.predict_series(known, ["l_suppkey"], "known", ["discount"], "month")
    return out.filter(F.col("month") >= F.lit(FORECAST_FROM)).select("l_suppkey", "month", "price", "prediction")


def _ols_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return models.fit_model(_signal_features(spark, sf), "OLS no intercept").predictions


def ols_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return _ols_predictions(spark, sf).select("date", "p_win", "prediction")


def eval_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.evaluate(_ols_predictions(spark, sf), "p_win").drop(
        "below_accuracy", "above_accuracy"
    )


def class_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.evaluate(_ols_predictions(spark, sf), "p_win").select(
        "n", "below_accuracy", "above_accuracy"
    )


def class_counts(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.class_counts(_ols_predictions(spark, sf), "p_win")


def _run_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, labels.LabelTables, run.Scorers]:
    """Posts, label tables on the posts' days, and scorers, in the layouts a run expects."""
    series = t.labels_daily(spark, sf)
    tables = labels.LabelTables(
        forecast=series.select(
            F.col("date").cast("string").alias("modeldate"),
            F.col("p_win").alias("ecwin_inc"),
            (1 - F.col("p_win")).alias("ecwin_chal"),
        ),
        market=series.select(
            F.date_format("date", "M/d/yyyy").alias("Date (ET)"),
            F.col("p_win").alias("Close Share Price"),
            F.col("p_win").alias("Average Trade Price"),
        ),
    )
    scorers = run.Scorers(
        t.lexicon(spark), t.lexicon(spark), scoring.LexiconAspectScorer(t.VALENCES)
    )
    return t.flagged_posts(spark, sf), tables, scorers


LINEAR = [("OLS", {}), ("Ridge", {"alpha": 0.1}), ("Lasso", {"alpha": 0.01})]
TREES = [("Gradient Boosting", {"n_estimators": n, "max_depth": 2}) for n in (20, 50, 100)]


def _grid(spark: SparkSession, sf: str, sentiments, models, sets=None) -> DataFrame:
    """Both splits, and every feature set a split has."""
    processed, tables, scorers = _run_inputs(spark, sf)
    # each scorer of each plan reads the posts: stored once, or each would shuffle the texts for their events
    processed = stage(processed, "posts")
    every_post = {"min_account_age": 0, "min_followers": 0, "min_likes": 0, "english_only": False}
    plans = [
        (run.Run(ENTITIES), [features.TWO_RATIOS, features.ONE_RATIO]),
        (run.Run(ENTITIES, feature_options=every_post, drop_missing=True), [features.ENHANCED]),
        # an aspect scorer has no ratio for an entity that a day does not mention
        (
            run.Run(ENTITIES, split=labels.TEST, label_type=labels.MARKET, drop_missing=True),
            [features.TWO_RATIOS, features.ONE_RATIO],
        ),
    ]
    grids = []
    for base, names in plans:
        wanted = [n for n in names if sets is None or n in sets]
        if wanted:
            grids.append(
                run.scenario_grid(processed, tables, scorers, base, sentiments=sentiments, features=wanted, models=models)
            )
    return reduce(DataFrame.unionAll, grids)


def scenario_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Every scorer, feature set and model of both splits; boosting with 20, 50 and 100 trees."""
    models = [*LINEAR, *TREES, ("SARIMAX", {"method": "likelihood"})]
    return _grid(spark, sf, [run.COMPOUND, run.POLARITY, run.ASPECT], models)


def scenario_grid_linear(spark: SparkSession, sf: str) -> DataFrame:
    """The part of the grid that has closed forms: linear models of one and two ratios, both splits."""
    sets = [features.TWO_RATIOS, features.ONE_RATIO]
    return _grid(spark, sf, [run.COMPOUND, run.POLARITY], LINEAR, sets)


def news_run(spark: SparkSession, sf: str) -> DataFrame:
    """One run of the test split: market labels, two ratios, OLS without intercept."""
    processed, tables, scorers = _run_inputs(spark, sf)
    plan = run.Run(ENTITIES, split="test", label_type=labels.MARKET, sentiment=run.POLARITY)
    fit, _ = run.execute(processed, tables, plan, scorers)
    return _params(fit)


def news_run_market_only(spark: SparkSession, sf: str) -> DataFrame:
    """The same with forecast labels asked for and market labels put in their place."""
    processed, tables, scorers = _run_inputs(spark, sf)
    plan = run.Run(
        ENTITIES, split="test", label_type=labels.FORECAST, market_only=True, sentiment=run.POLARITY
    )
    fit, _ = run.execute(processed, tables, plan, scorers)
    return _params(fit)


# --- sources and sinks: what is written is what is read back --------------------------


def posts_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "posts-csv")
    sinks.write_csv(t.posts(spark, sf).select(
        "created_at", "tweet_id", "tweet", "likes", "user_join_date",
        "user_followers_count", "country",
    ), path)
    return files.read_posts(spark, path).drop("row_order")


def posts_csv_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Files with more columns than are asked for, in another order."""
    path = stage_path(spark, "posts-wide")
    sinks.write_csv(t.posts(spark, sf).select(
        F.lit("web").alias("source"), "country", "tweet", F.lit(7).alias("retweet_count"), "tweet_id",
        "user_followers_count", "created_at", "user_join_date", "likes",
    ), path)
    return files.read_posts(spark, path).drop("row_order")


def toplines_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Topline labels from a file with the columns such files have around the three that count."""
    path = stage_path(spark, "toplines")
    sinks.write_csv(t.toplines(spark, sf).select(
        F.lit(2020).alias("cycle"), F.lit("President").alias("branch"), F.lit("polls-plus").alias("model"),
        "modeldate", "ecwin_chal", F.lit(0.5).alias("popwin_inc"), "ecwin_inc",
    ), path)
    return labels.topline_labels(files.read_csv(spark, path, TOPLINES))


def _awkward_keys(docs: DataFrame) -> DataFrame:
    """Documents under keys that are null for a third of them and repeat for another."""
    third = F.col("doc_id") % 3
    key = F.when(third == 0, None).when(third == 1, F.col("doc_id") % 50).otherwise(F.col("doc_id"))
    return docs.withColumn("key", key)


def lexicon_score_by_row(spark: SparkSession, sf: str) -> DataFrame:
    docs = _awkward_keys(t.documents(spark, sf)).select("key", "doc_id", "text")
    return lexicon.score_rows(docs, lexicon.compound_scorer(t.lexicon(spark), None), "text").drop("text")


def language_id_by_row(spark: SparkSession, sf: str) -> DataFrame:
    """Both ways of language identification, by size of the profiles, side by side."""
    docs = t.documents(spark, sf)
    profiles = language.build_profiles(docs, "text", "lang", t.LANGUAGES)
    docs = _awkward_keys(docs).select("key", "doc_id", "text")
    both = language.flag_language(docs, profiles, text="text", flag="in_place")
    both = language.flag_language(both, profiles, text="text", flag="by_join", max_rows=0)
    return both.drop("text")


def sentiment_table(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "sentiment")
    scored = daily.with_day(_scored_posts(spark, sf)).select(
        "tweet_id", "date", *[label_of(e) for e in ENTITIES]
    )
    sinks.write_table(scored, path, ["date"])
    return files.read_table(spark, path, scored.schema)


def articles_json(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "articles")
    sinks.write_articles(
        t.articles(spark, sf).withColumnRenamed("article_id", "uuid"), path
    )
    return files.read_articles(spark, path).select("uuid", "title", "description", "published_at")


def articles_array_json(spark: SparkSession, sf: str) -> DataFrame:
    """The same from files that hold an array each, 25 articles to a file's line break."""
    path = stage_path(spark, "articles-array")
    record = F.struct(F.col("article_id").cast("string").alias("uuid"), "title", "description", "published_at")
    (
        t.articles(spark, sf)
        .groupBy(F.floor(F.col("article_id") / article_search.PAGE_SIZE).alias("page"))
        .agg(F.to_json(F.collect_list(record), {"timestampFormat": sinks.MICROSECONDS}).alias("value"))
        .select("value")
        .write.text(path)
    )
    return files.read_articles(spark, path).select("uuid", "title", "description", "published_at")


def news_records_json(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "news-records")
    sinks.write_news_records(
        preparation.prepare_articles(t.articles(spark, sf), ENTITIES), path
    )
    return spark.read.schema(processed_news(ENTITIES)).json(path)


def nested_json(spark: SparkSession, sf: str) -> DataFrame:
    """Records in the older nested layout: ``[[...]]`` documents of 25, one per line."""
    path = stage_path(spark, "nested")
    records = sinks.news_records(
        preparation.prepare_articles(t.articles(spark, sf), ENTITIES, keep=["article_id"])
    )
    record = F.struct("textdata", "timestamp", *[mention(e) for e in ENTITIES])
    (
        records.groupBy(F.floor(F.col("article_id") / article_search.PAGE_SIZE).alias("page"))
        .agg(F.to_json(F.array(F.collect_list(record))).alias("value"))
        .select("value")
        .write.text(path)
    )
    return files.read_nested_records(spark, path, ENTITIES, per_line=True)


def _write_pages(spark: SparkSession, sf: str, path: str) -> None:
    """Result pages of 25 articles, a JSON line per page."""
    (
        t.articles(spark, sf)
        .withColumnRenamed("article_id", "uuid")
        .groupBy(F.floor(F.col("uuid") / article_search.PAGE_SIZE).alias("page"))
        .agg(F.collect_list(F.struct("uuid", "title", "description", "published_at")).alias("data"))
        .select("data")
        .write.option("timestampFormat", sinks.MICROSECONDS)
        .json(path)
    )


PAGE_RECORD = (
    T.StructType()
    .add("uuid", T.LongType())
    .add("title", T.StringType())
    .add("description", T.StringType())
    .add("published_at", T.TimestampType())
)


def article_pages(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "pages")
    _write_pages(spark, sf, path)
    return files.read_article_pages(spark, path, PAGE_RECORD)


def collected_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The same pages through the incremental collector, called twice: each page once."""
    pages, out = stage_path(spark, "pages"), stage_path(spark, "collected")
    _write_pages(spark, sf, pages)
    for _ in range(2):
        collect_pages(spark, pages, out, f"{out}-progress", PAGE_RECORD)
    return files.read_table(spark, out, PAGE_RECORD)


def params_table(spark: SparkSession, sf: str) -> DataFrame:
    root = stage_path(spark, "params")
    fit = models.fit_model(_signal_features(spark, sf), "OLS no intercept")
    path = sinks.write_params(fit, root, "train", run.COMPOUND, features.TWO_RATIOS)
    schema = "params string, " + ", ".join(f"{c} double" for c in fit.betas)
    return files.read_csv(spark, path, T.StructType.fromDDL(schema))


def sentiment_days(spark: SparkSession, sf: str) -> DataFrame:
    """The sentiment table by day, written in three runs that overlap: the last one of a day counts."""
    path = stage_path(spark, "sentiment-days")
    scored = daily.with_day(_scored_posts(spark, sf)).select("tweet_id", "date", *[label_of(e) for e in ENTITIES])
    scored = stage(scored, "sentiment-scored")
    middle = F.lit(date(2024, 1, 15))
    wrong = scored.withColumns({label_of(e): F.lit("neutral") for e in ENTITIES})
    days.write_days(wrong, path)
    days.write_days(scored.filter(F.col("date") <= middle), path)
    days.write_days(scored.filter(F.col("date") >= middle), path)
    return days.read_days(spark, path)


def merged_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Posts merged in four batches, later rows of each source first."""
    path = stage_path(spark, "merged")
    sources = t.post_sources(spark, sf)
    for part in (3, 1, 2, 0):
        batch = {e: df.filter(F.floor(F.col("tweet_id") / 7) % 4 == part) for e, df in sources.items()}
        merging.add_batch(spark, path, batch, ENTITIES)
    return merging.merged_rows(spark, path, ENTITIES).drop("is_en", "source_rank", "row_order")


def stored_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Three stored models applied to the daily features at once."""
    root = stage_path(spark, "params")
    table = _signal_features(spark, sf)
    for name, options in (("OLS no intercept", {}), ("Linear Regression", {}), ("Ridge", {"alpha": 2.0})):
        sinks.write_params(models.fit_model(table, name, **options), root, "train", run.COMPOUND, features.TWO_RATIOS)
    return stored.apply_params(table.drop("p_win"), stored.read_params(spark, root))


def articles_array_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Articles from files that hold an array of up to 500 each, read by byte ranges."""
    path = stage_path(spark, "articles-ranges")
    record = F.struct(F.col("article_id").cast("string").alias("uuid"), "title", "description", "published_at")
    (
        t.articles(spark, sf)
        .groupBy(F.floor(F.col("article_id") / 500).alias("file"))
        .agg(F.to_json(F.collect_list(record), {"timestampFormat": sinks.MICROSECONDS}).alias("value"))
        .select("value")
        .write.option("maxRecordsPerFile", 1)
        .text(path)
    )
    return files.read_article_arrays(spark, path).select("uuid", "title", "description", "published_at")


def feature_export(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "features")
    table = features_two_ratios(spark, sf)
    sinks.write_table(table, path)
    return files.read_table(spark, path, table.schema)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        clean_text,
        mention_flags,
        compose_text,
        prompt_template,
        search_articles,
        search_index,
        search_index_without,
        flag_propagation,
        tag_union_dedup,
        account_age_filter,
        epoch_roundtrip,
        parsed_dates,
        parsed_timestamps,
        prepare_posts,
        prepare_articles,
        language_profiles,
        language_id,
        language_id_by_join,
        lexicon_score,
        lexicon_score_shifters,
        lexicon_score_by_row,
        lexicon_score_by_join,
        phrase_score,
        phrase_score_by_join,
        phrase_score_shifters,
        phrase_polarity,
        language_id_by_row,
        news_run_market_only,
        posts_csv_wide,
        toplines_csv,
        articles_array_json,
        articles_array_ranges,
        sentiment_days,
        merged_batches,
        stored_predictions,
        mean_polarity,
        sentiment_label,
        softmax_label,
        aspect_batch,
        aspect_prompt,
        aspect_model,
        unpivot_entities,
        entity_summary,
        label_counts,
        daily_ratio_long,
        daily_ratio_pivot,
        daily_ratio_one,
        daily_ratio_wide,
        daily_ratio_wide_mentions,
        daily_mean,
        candidate_indicator,
        rolling_mean,
        rolling_mean_per_entity,
        softsign_measures,
        forecast_labels,
        topline_labels,
        market_labels_close,
        market_labels_average,
        features_two_ratios,
        features_one_ratio,
        news_two_ratios,
        news_one_ratio,
        enhanced_features,
        ols_no_intercept,
        linear_fit,
        ridge_fit,
        lasso_fit,
        linear_fit_two,
        ridge_fit_two,
        lasso_fit_two,
        rolling_target_fit,
        penalty_path,
        gbt_fit,
        gbt_stump,
        arimax_fit,
        arimax_series,
        arimax_forecasts,
        ols_predictions,
        eval_metrics,
        class_accuracy,
        class_counts,
        scenario_grid,
        scenario_grid_linear,
        news_run,
        posts_csv,
        sentiment_table,
        articles_json,
        news_records_json,
        nested_json,
        article_pages,
        collected_pages,
        params_table,
        feature_export,
    )
}


def registered() -> dict[str, Query]:
    """Every query, on a configured session, with comparable result types."""

    def wrap(query: Query) -> Query:
        return lambda spark, sf: report(query(configure(spark), sf))

    return {name: wrap(query) for name, query in QUERIES.items()}
