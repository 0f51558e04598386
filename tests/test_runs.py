import datetime as dt
import random
from dataclasses import replace

import pytest

from moodline.operators import labels as L
from moodline.operators.language import build_profiles
from moodline.operators.scoring import LexiconAspectScorer
from moodline.plans import preparation, run
from moodline.plans.features import ENHANCED, ONE_RATIO, TWO_RATIOS, build_features

WORDS = {"great": 2.0, "awful": -2.0, "nice": 1.0}
START = dt.datetime(2020, 10, 1, 12)
DAYS = 25


@pytest.fixture(scope="module")
def scorers(spark):
    table = spark.createDataFrame(list(WORDS.items()), "token string, valence double")
    return run.Scorers(table, table, LexiconAspectScorer(WORDS))


@pytest.fixture(scope="module")
def processed(spark):
    rng = random.Random(9)
    rows = []
    for i in range(600):
        rows.append(
            (
                i,
                " ".join(rng.choice([*WORDS, "the", "day"]) for _ in range(6)),
                START + dt.timedelta(days=rng.randrange(DAYS), seconds=i),
                rng.random() < 0.9,
                "US",
                float(rng.randrange(20)),
                START - dt.timedelta(days=rng.randrange(400)),
                float(rng.randrange(20)),
                rng.randint(0, 1),
                rng.randint(0, 1),
            )
        )
    return spark.createDataFrame(
        rows,
        "tweet_id long, textdata string, timestamp timestamp, is_en boolean, country string, "
        "likes double, user_join_date timestamp, user_followers_count double, "
        "mentions_trump int, mentions_biden int",
    )


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(1)
    days = [(START + dt.timedelta(days=i)).date() for i in range(DAYS)]
    prices = [(str(d), rng.uniform(0.4, 0.6), rng.uniform(0.4, 0.6)) for d in days]
    return L.LabelTables(
        forecast=spark.createDataFrame(
            [(f"{d.month}/{d.day}/{d.year}", 0.3 + 0.01 * i, 0.7 - 0.01 * i) for i, d in enumerate(days)],
            "modeldate string, ecwin_inc double, ecwin_chal double",
        ),
        market=spark.createDataFrame(
            prices, "`Date (ET)` string, `Close Share Price` double, `Average Trade Price` double"
        ),
    )


BASE = run.Run(("trump", "biden"))


@pytest.mark.parametrize(
    ("plan", "features"),
    [
        (BASE, ("trump", "biden")),
        (run.Run(BASE.entities, features=ONE_RATIO, model="Ridge", model_options={"alpha": 0.1}), ("ratio",)),
        (run.Run(BASE.entities, sentiment=run.ASPECT, label_type=L.MARKET), ("trump", "biden")),
        (
            run.Run(
                BASE.entities,
                sentiment=run.POLARITY,
                split="test",
                label_type=L.MARKET,
                trade_type="average",
            ),
            ("trump_ratio", "biden_ratio"),
        ),
        (
            run.Run(BASE.entities, features=ENHANCED, rolling=True, feature_options={"min_likes": 2}),
            tuple(
                f"{e}{suffix}"
                for suffix in ("", "_sentiment_indic", "_rolling_sentiment_indic")
                for e in BASE.entities
            ),
        ),
    ],
)
def test_run(processed, tables, scorers, plan, features):
    fit, metrics = run.execute(processed, tables, plan, scorers)
    assert fit.features == features
    row = metrics.first()
    assert row["n"] == DAYS and 0 <= row["accuracy"] <= 1


def test_stored_sentiment_skips_scoring(processed, tables, scorers):
    scored = run.score_texts(processed, BASE, scorers)
    assert "trump_sentiment_score" in scored.columns and "textdata" not in scored.columns
    a, _ = run.execute(processed, tables, BASE, scorers)
    b, _ = run.execute(None, tables, BASE, run.Scorers(), sentiment=scored)
    assert a.betas == pytest.approx(b.betas)


def test_aspect_scores_are_not_carried(processed, scorers):
    plan = run.Run(BASE.entities, sentiment=run.ASPECT)
    out = run.score_texts(processed, plan, scorers)
    assert not [c for c in out.columns if c.endswith("_score")]


def test_grid(processed, tables, scorers):
    grid = run.scenario_grid(
        processed,
        tables,
        scorers,
        BASE,
        sentiments=[run.COMPOUND, run.ASPECT],
        features=[TWO_RATIOS, ONE_RATIO],
        models=[("OLS", {}), ("Ridge", {"alpha": 1.0})],
    )
    rows = grid.collect()
    assert len({(r["sentiment"], r["features"], r["model"]) for r in rows}) == len(rows) == 8
    assert {r["evaluated_on"] for r in rows} == {"train"}
    ols = {(r["sentiment"], r["features"]): r["r2"] for r in rows if r["model"] == "OLS"}
    ridge = {(r["sentiment"], r["features"]): r["r2"] for r in rows if r["model"] == "Ridge"}
    assert all(ols[k] >= ridge[k] for k in ols)


@pytest.mark.parametrize(
    "change",
    [
        {"sentiment": "x"},
        {"features": "x"},
        {"model": "x"},
        {"label_type": "x"},
        {"trade_type": "x"},
        {"split": "x"},
        {"split": "test", "features": ENHANCED},
    ],
)
def test_unknown_names(change):
    with pytest.raises(ValueError, match="unknown"):
        replace(BASE, **change)


def test_enhanced_per_entity(processed, tables, scorers):
    from moodline.operators.scoring import long_by_entity

    labels = L.label_series(tables)
    keep = ["timestamp", "is_en", "likes", "user_join_date", "user_followers_count"]
    scored = run.score_texts(processed, BASE, scorers)
    rows = long_by_entity(scored, BASE.entities, keep)
    mixed = build_features(rows, labels, BASE.entities, ENHANCED)
    own = build_features(rows, labels, BASE.entities, ENHANCED, per_entity=True)
    first = own.orderBy("date").first()
    assert first["trump_rolling_sentiment_indic"] == first["trump_sentiment_indic"]
    assert mixed.count() == own.count()
    assert mixed.exceptAll(own).count() > 0


def test_preparation(spark):
    train = [("the cat and the dog that", "en"), ("le chat et les chiens que", "fr")]
    profiles = build_profiles(spark.createDataFrame(train, "t string, l string"), "t", "l", ["en", "fr"])
    schema = "tweet_id long, tweet string, created_at string, row_order long"
    a = spark.createDataFrame(
        [(1, "The cat! http://x.y @me #that", "2020-10-15 00:00:01", 0), (2, "les chats", None, 1)], schema
    )
    out = preparation.prepare_posts({"biden": a, "trump": a.limit(1)}, profiles)
    got = {r["tweet_id"]: r for r in out.collect()}
    assert got[1]["textdata"] == "the cat   that" and got[1]["is_en"] is True
    assert got[1]["timestamp"] == dt.datetime(2020, 10, 15, 0, 0, 1)
    assert (got[1]["mentions_biden"], got[1]["mentions_trump"]) == (1, 1)
    assert got[2]["is_en"] is False and got[2]["timestamp"] is None
    assert "tweet" not in out.columns and "row_order" not in out.columns


def test_dump(spark, tmp_path):
    train = [("the cat and the dog that", "en")]
    profiles = build_profiles(spark.createDataFrame(train, "t string, l string"), "t", "l", ["en"])
    posts = spark.createDataFrame(
        [(1, "The cat!", "2020-10-15", 0)],
        "tweet_id long, tweet string, created_at string, row_order long",
    )
    path = str(tmp_path / "processed")
    out = preparation.prepare_posts({"biden": posts}, profiles, dump_path=path)
    assert out.inputFiles() and out.first()["textdata"] == "the cat"
    assert spark.read.parquet(path).count() == 1


def test_article_preparation(spark):
    rows = [("Trump WINS", "so says Harris", dt.datetime(2024, 1, 1)), ("Other", None, None)]
    df = spark.createDataFrame(rows, "title string, description string, published_at timestamp")
    out = preparation.prepare_articles(df, ["trump", "harris"]).collect()
    assert tuple(out[0]) == ("trump wins . so says harris", rows[0][2], 1, 1)
    assert tuple(out[1]) == ("other", None, 0, 0)


def test_a_run_stores_its_coefficients(spark, processed, tables, scorers, tmp_path):
    plan = replace(BASE, label_type=L.FORECAST, market_only=True)
    fit, _ = run.execute(processed, tables, plan, scorers, params_root=str(tmp_path))
    same, _ = run.execute(processed, tables, replace(BASE, label_type=L.MARKET), scorers)
    assert fit.betas == pytest.approx(same.betas)
    path = f"{tmp_path}/train/VADER_{plan.features}_{fit.name}_params"
    row = spark.read.option("header", True).csv(path).first()
    assert {k: float(row[k]) for k in fit.betas} == pytest.approx(dict(fit.betas))


def test_grid_stores_the_posts_for_its_scorers(spark, monkeypatch):
    """Each scorer of each plan reads them: what joins texts with events must not run again."""
    from workload import queries

    given = []

    class Enough(Exception):
        pass

    def grid(processed, *args, **kwargs):
        given.append(processed)
        raise Enough

    monkeypatch.setattr(queries.run, "scenario_grid", grid)
    with pytest.raises(Enough):
        queries.scenario_grid_linear(spark, "/root/testdata/sf0.001")
    assert "Join" not in given[0]._jdf.queryExecution().optimizedPlan().toString()
