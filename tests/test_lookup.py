import pytest
from pyspark.sql import functions as F

from moodline.operators.lookup import fits_broadcast, lookup_join


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_broadcast_join(spark, how):
    # one token is a third of all rows
    left = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id") % 50)).alias("token")
    )
    lookup = spark.createDataFrame([("hot", 1.0), *[(f"w{i}", float(i)) for i in range(40)]], "token string, v double")
    small = lookup_join(left, lookup, "token", how=how, spread="id")
    large = lookup_join(left, lookup, "token", how=how, spread="id", max_rows=3, salt_buckets=5)
    assert sorted(map(tuple, small.select("id", "token", "v").na.fill(-1).collect())) == sorted(
        map(tuple, large.select("id", "token", "v").na.fill(-1).collect())
    )
    assert "_salt" not in large.columns


def test_size_check(spark):
    df = spark.createDataFrame([("abc", 1.0)] * 10, "token string, v double")
    assert fits_broadcast(df, max_rows=10)
    assert not fits_broadcast(df, max_rows=9)
    assert not fits_broadcast(df, max_bytes=100)


def test_unknown_join_type(spark):
    df = spark.createDataFrame([("a",)], "token string")
    with pytest.raises(ValueError):
        lookup_join(df, df, "token", how="full")
