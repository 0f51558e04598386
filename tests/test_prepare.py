import datetime as dt
import random

from moodline.operators.prepare import (
    flag_mentions,
    merge_duplicates,
    propagate_flags,
    quality_filter,
    tag_sources,
)
from moodline.plans.preparation import merge_posts

SCHEMA = "tweet_id long, tweet string, row_order long"


def sources(spark):
    a = spark.createDataFrame([(1, "a1", 0), (2, "a2", 1), (2, "a2 again", 2), (None, "a null", 3)], SCHEMA)
    b = spark.createDataFrame([(2, "b2", 0), (3, "b3", 1), (None, "b null", 2)], SCHEMA)
    return {"x": a, "y": b}


WANT = {(1, "a1", 1, 0), (2, "a2", 1, 1), (3, "b3", 0, 1), (None, "a null", None, None)}


def rows(df):
    return {tuple(r) for r in df.select("tweet_id", "tweet", "mentions_x", "mentions_y").collect()}


def test_merge_keeps_first_and_all_flags(spark):
    assert rows(merge_posts(sources(spark))) == WANT


def test_propagated_flags(spark):
    tagged = tag_sources(sources(spark))
    got = propagate_flags(tagged, "tweet_id", ["x", "y"])
    want = {1: (1, 0), 2: (1, 1), 3: (0, 1), None: (None, None)}
    rows = got.collect()
    assert len(rows) == tagged.count()
    assert all((r["mentions_x"], r["mentions_y"]) == want[r["tweet_id"]] for r in rows)


def test_merge_does_not_depend_on_partitioning(spark):
    tagged = tag_sources(sources(spark))
    for n in (1, 3, 7):
        merged = merge_duplicates(
            tagged.repartition(n), "tweet_id", ["x", "y"], ["source_rank", "row_order"]
        )
        assert rows(merged) == WANT


def test_merge_twice_changes_nothing(spark):
    once = merge_duplicates(
        tag_sources(sources(spark)), "tweet_id", ["x", "y"], ["source_rank", "row_order"]
    )
    again = merge_duplicates(once, "tweet_id", ["x", "y"], ["source_rank", "row_order"])
    assert rows(again) == WANT


def test_hot_key_shrinks_before_the_shuffle(spark):
    data = [(7 if i % 3 == 0 else i, f"t{i}", i) for i in range(3000)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    merged = merge_posts({"x": df})
    assert merged.filter("tweet_id = 7").collect()[0]["tweet"] == "t0"
    assert merged.count() == len({row[0] for row in data})
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and plan.count("Exchange hashpartitioning") == 1


def test_columns_missing_in_one_source(spark):
    a = spark.createDataFrame([(1, "a", 0)], SCHEMA)
    b = a.selectExpr("tweet_id + 1 AS tweet_id", "'only here' AS extra", "row_order")
    got = {r["tweet_id"]: r["extra"] for r in tag_sources({"x": a, "y": b}).collect()}
    assert got == {1: None, 2: "only here"}


def test_quality_filter(spark):
    t = dt.datetime
    old, new = t(2020, 1, 1), t(2020, 6, 1)
    data = [
        (1, new, old, 6.0, 6.0, True),
        (2, new, old, 5.0, 6.0, True),
        (3, new, old, 6.0, 5.0, True),
        (4, old + dt.timedelta(days=30), old, 6.0, 6.0, True),
        (5, new, old, float("nan"), 6.0, True),
        (6, new, old, 6.0, None, True),
        (7, new, old, 6.0, 6.0, False),
        (8, new, old, 6.0, 6.0, None),
    ]
    df = spark.createDataFrame(
        data,
        "id int, timestamp timestamp, user_join_date timestamp, user_followers_count double, "
        "likes double, is_en boolean",
    )
    assert [r["id"] for r in quality_filter(df).collect()] == [1]
    assert [r["id"] for r in quality_filter(df, english_only=False).collect()] == [1, 7, 8]


def test_flags(spark):
    df = spark.createDataFrame([("Trump and harris",), (None,)], "t string")
    got = [tuple(r)[1:] for r in flag_mentions(df, "t", ["trump", "harris"]).collect()]
    assert got == [(1, 1), (0, 0)]
