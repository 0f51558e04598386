"""Tables that are written again, merging by batches, and scoring with stored parameters."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from moodline.operators import models, stored
from moodline.operators.prepare import merge_duplicates, tag_sources
from moodline.sources import days, sinks
from moodline.streaming import merging

D = [date(2024, 1, k) for k in range(1, 8)]


def day_rows(spark, names, tag):
    rows = [(d, f"{tag}{k}", None if k else d) for d in names for k in range(3)]
    return spark.createDataFrame(rows, "date date, label string, extra date")


def shown(df):
    return sorted(map(repr, df.collect()))


def test_a_rerun_replaces_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError, match="nothing"):
        days.read_days(spark, path)
    days.write_days(day_rows(spark, D[:5], "old"), path)
    days.write_days(day_rows(spark, D[3:], "new"), path)
    want = day_rows(spark, D[:3], "old").unionAll(day_rows(spark, D[3:], "new"))
    assert shown(days.read_days(spark, path)) == shown(want)
    days.write_days(day_rows(spark, [D[0]], "x"), path, days=[D[0], D[1]])  # the second day is empty now
    want = want.filter(~F.col("date").isin(D[:2])).unionAll(day_rows(spark, [D[0]], "x"))
    assert shown(days.read_days(spark, path)) == shown(want)
    with pytest.raises(ValueError, match="not to be replaced"):
        days.write_days(day_rows(spark, D[:2], "y"), path, days=[D[0]])
    assert shown(days.read_days(spark, path)) == shown(want)
    null = spark.createDataFrame([(None, "n", None)], "date date, label string, extra date")
    days.write_days(null, path)
    assert shown(days.read_days(spark, path)) == shown(want.unionAll(null))


def test_a_crashed_write_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    days.write_days(day_rows(spark, D[:3], "old"), path)
    broken = day_rows(spark, D[:5], "new").withColumn(
        "label", F.when(F.col("date") == D[4], F.raise_error(F.lit("lost"))).otherwise(F.col("label"))
    )
    with pytest.raises(Exception, match="lost"):
        days.write_days(broken, path)
    # cut off between the rows and the manifest
    sinks.write_table(day_rows(spark, D[:2], "half"), f"{path}/data/run=99999999999999999999-x", ["date"])
    assert shown(days.read_days(spark, path)) == shown(day_rows(spark, D[:3], "old"))


def posts(n, seed):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(n // 3)]), f"text {seed} {k}", (seed, k)) for k in range(n)]


SCHEMA = "tweet_id long, tweet string, row_order struct<file:int,row:int>"


@pytest.mark.parametrize("cuts", [[0, 60], [0, 20, 60], [0, 10, 11, 35, 60]])
@pytest.mark.parametrize("turned", [False, True])
def test_any_batches_give_one_run(spark, tmp_path, cuts, turned):
    a, b = posts(60, 1), posts(60, 2)
    whole = {"x": spark.createDataFrame(a, SCHEMA), "y": spark.createDataFrame(b, SCHEMA)}
    want = merge_duplicates(tag_sources(whole), "tweet_id", ["x", "y"], ["source_rank", "row_order"])
    path, pieces = str(tmp_path / "m"), list(zip(cuts, cuts[1:], strict=False))
    for k, (lo, hi) in enumerate(reversed(pieces) if turned else pieces):
        batch = {"x": a[lo:hi], "y": b[lo:hi]}
        if k % 2:  # a batch of one source only, then the other
            merging.add_batch(spark, path, {"y": spark.createDataFrame(batch.pop("y"), SCHEMA)}, ["x", "y"])
        given = {e: spark.createDataFrame(r, SCHEMA) for e, r in batch.items()}
        merging.add_batch(spark, path, given, ["x", "y"])
    got = merging.merged_rows(spark, path, ["x", "y"])
    assert shown(got.select(*want.columns)) == shown(want)


def test_a_batch_given_twice_or_cut_off(spark, tmp_path):
    path = str(tmp_path / "m")
    df = spark.createDataFrame(posts(30, 3), SCHEMA)
    merging.add_batch(spark, path, {"x": df}, ["x", "y"])
    want = shown(merging.merged_rows(spark, path, ["x", "y"]))
    merging.add_batch(spark, path, {"x": df}, ["x", "y"])
    assert shown(merging.merged_rows(spark, path, ["x", "y"])) == want
    bad = df.withColumn("tweet", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        merging.add_batch(spark, path, {"y": bad}, ["x", "y"])
    assert shown(merging.merged_rows(spark, path, ["x", "y"])) == want
    with pytest.raises(ValueError, match="unknown"):
        merging.add_batch(spark, path, {"z": df}, ["x", "y"])


def test_stored_parameters(spark, tmp_path):
    rows = [(date(2024, 1, 1 + k % 28), float(k), float((k * 7) % 5), 0.1 * k + (k % 3)) for k in range(40)]
    df = spark.createDataFrame(rows, "date date, a double, `b c` double, p_win double").repartition(3)
    root, fits = str(tmp_path / "params"), {}
    for name, options in (("OLS", {}), ("OLS no intercept", {}), ("Ridge", {"alpha": 3.0})):
        fit = models.fit_model(df, name, **options)
        sinks.write_params(fit, root, "train", "VADER", "2RATIOS")
        fits[f"train/VADER_2RATIOS_{fit.name}"] = fit
    params = stored.read_params(spark, root)
    assert {r.run for r in params.collect()} == set(fits)
    got = stored.apply_params(df, params, keep=["date", "p_win"]).collect()
    for run, fit in fits.items():
        want = sorted((r.date, r.p_win, r.prediction) for r in fit.predictions.collect())
        own = sorted((r.date, r.p_win, r.prediction) for r in got if r.run == run)
        assert [x[:2] for x in own] == [x[:2] for x in want]
        assert [x[2] for x in own] == pytest.approx([x[2] for x in want])
    gap = df.limit(1).withColumn("a", F.lit(None).cast("double"))
    by_run = {r.run.rsplit("_", 1)[1]: r.prediction for r in stored.apply_params(gap, params, keep=["date", "p_win"]).collect()}
    assert by_run["linear"] is None and by_run["ridge"] is None and by_run["intercept"] is not None
    with pytest.raises(Exception, match="missing"):
        stored.apply_params(df.drop("a"), params, keep=["date", "p_win"]).collect()
