import pytest
from pyspark.sql import functions as F

from affilix.operators.skew import _bytes, grid_join, hot_keys, will_broadcast


def sides(spark):
    """Key 0 holds half of the left rows and a third of the right; 9 is on the left only, NULL on both."""
    left = spark.range(400).select(
        F.when(F.col("id") < 200, 0).when(F.col("id") < 210, F.lit(None)).when(F.col("id") < 250, 9)
        .otherwise(F.col("id") % 7).cast("int").alias("k"), F.col("id").alias("l")
    )
    right = spark.range(60).select(
        F.when(F.col("id") < 20, 0).when(F.col("id") < 22, F.lit(None)).otherwise(F.col("id") % 7).cast("int").alias("k"),
        F.col("id").alias("r"),
    )
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("task_pairs", [1, 50, 10**9])
def test_grid_join_is_the_join(spark, no_broadcast, how, task_pairs):
    left, right = sides(spark)
    got = grid_join(left, right, ["k"], how, spread_left=["l"], spread_right=["r"], task_pairs=task_pairs)
    rows = sorted(map(str, got.select("k", "l", "r").collect()))
    assert rows == sorted(map(str, left.join(right, "k", how).select("k", "l", "r").collect()))


def test_hot_key_is_split_both_ways(spark, no_broadcast):
    left, right = sides(spark)
    keys = {r.k: r for r in hot_keys(left, right, ["k"], 100).collect()}
    assert keys[0]._l > 200 and keys[0]._r > 20 and keys[0]._cells >= 40


def test_small_side_is_left_to_spark(spark):
    left, right = sides(spark)
    assert will_broadcast(right)
    joined = grid_join(left, right, ["k"], spread_left=["l"], spread_right=["r"])
    assert "_cl" not in joined._jdf.queryExecution().toString()


def test_size_settings():
    assert [_bytes(s) for s in ("10485760b", "10MB", "1g", "-1", "77")] == [10485760, 10 << 20, 1 << 30, -1, 77]


def test_null_keys_hide_no_hot_key(spark, no_broadcast):
    left = spark.range(31_000).select(F.when(F.col("id") < 1000, 1).cast("int").alias("k"), F.col("id").alias("l"))
    right = spark.range(30_080).select(F.when(F.col("id") < 80, 1).cast("int").alias("k"), F.col("id").alias("r"))
    found = hot_keys(left, right, ["k"], 10_000).collect()
    assert [(r.k, r._l, r._r) for r in found] == [(1, 1000, 80)]


def test_more_hot_keys_than_are_broadcast(spark, no_broadcast, monkeypatch):
    from affilix.operators import skew

    monkeypatch.setattr(skew, "MAX_HOT", 3)
    left, right = sides(spark)
    got = grid_join(left, right, ["k"], spread_left=["l"], spread_right=["r"], task_pairs=1)
    assert sorted(map(str, got.select("k", "l", "r").collect())) == sorted(
        map(str, left.join(right, "k").select("k", "l", "r").collect())
    )
