import math

import pytest

from moodline.operators.evaluation import class_counts, evaluate


def metrics(spark, pairs):
    return evaluate(spark.createDataFrame(pairs, "y double, prediction double"), "y").first()


def test_metrics(spark):
    got = metrics(spark, [(0.2, 0.3), (0.4, 0.6), (0.8, 0.7), (0.6, 0.55)])
    assert got["n"] == 4
    assert got["accuracy"] == 0.75
    assert got["below_accuracy"] == 0.5 and got["above_accuracy"] == 1.0
    assert got["mae"] == pytest.approx(0.1125)
    assert got["rmse"] == pytest.approx(math.sqrt(0.0625 / 4))
    assert got["r2"] == pytest.approx(1 - 0.0625 / 0.2)
    assert got["mape"] == pytest.approx(100 * (0.5 + 0.5 + 0.125 + 1 / 12) / 4)


def test_one_half_is_on_both_sides(spark):
    got = metrics(spark, [(0.5, 0.4), (0.5, 0.5)])
    assert got["accuracy"] == 1.0  # not above 0.5, like 0.4
    assert got["above_accuracy"] == 0.5 and got["below_accuracy"] == 0.0


def test_zero_and_constant_truth(spark):
    assert metrics(spark, [(0.0, 0.1), (1.0, 1.0)])["mape"] == math.inf
    assert metrics(spark, [(0.0, 0.0), (1.0, 0.5)])["mape"] == 50.0
    assert metrics(spark, [(0.5, 0.5), (0.5, 0.5)])["r2"] == 1.0
    assert metrics(spark, [(0.5, 0.6), (0.5, 0.5)])["r2"] == 0.0


def test_rows_without_prediction_do_not_count(spark):
    assert metrics(spark, [(0.2, None), (0.2, 0.2)])["n"] == 1


def test_class_counts(spark):
    df = spark.createDataFrame([(0.6, 0.4), (0.7, 0.9), (0.5, 0.2)], "y double, prediction double")
    got = {(r["kind"], r["class"]): r["n"] for r in class_counts(df, "y").collect()}
    assert got == {("actual", 1): 2, ("actual", 0): 1, ("predicted", 0): 2, ("predicted", 1): 1}
