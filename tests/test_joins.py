"""Joins over keys that many rows share, against plain Python."""

import pytest
from pyspark.sql import functions as F

from strata.operators import joins

PAIRS = [("k1", "a1"), ("k2", "a2")]


def _sides(spark):
    """A value that a third of the rows of both sides hold, values of few rows, nulls, repeats, and columns named like the join's own."""
    left = [(i, "hot" if i % 3 == 0 else f"v{i % 20}", None if i % 7 == 0 else f"w{i % 5}") for i in range(90)] + [(0, "hot", None), (1, None, None), (1, "", "")]
    right = [(i, ["hot", "hot", None] if i % 3 == 0 else [f"v{i % 30}"], None if i % 11 == 0 else [f"w{i % 40}", ""]) for i in range(120)] + [(3, ["hot"], [])] * 2
    return left, right, spark.createDataFrame(left, "i int, k1 string, k2 string"), spark.createDataFrame(right, "row int, a1 array<string>, a2 array<string>")


@pytest.mark.parametrize("block", [1, 7, joins.BLOCK])
def test_membership_join_of_hot_values(spark, block):
    left, right, l_df, r_df = _sides(spark)
    got = joins.array_membership_join(l_df, r_df, PAIRS, left_keep=["i"], right_keep=["row"], block=block)
    assert got.columns == ["i", "row"]
    want = {(a[0], b[0]) for a in left for b in right if any(k is not None and k in (arr or []) for k, arr in zip(a[1:], b[1:], strict=True))}
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("block", [1, 7, joins.BLOCK])
def test_bridge_join_of_hot_values(spark, block):
    left, right, l_df, r_df = _sides(spark)
    r_df = r_df.select("row", F.get("a1", F.lit(0)).alias("b1"), F.get("a2", F.lit(1)).alias("b2"))
    got = joins.multi_bridge_join(l_df, r_df, [("k1", "b1"), ("k2", "b2")], left_keep=["i"], right_keep=["row"], block=block)
    flat = [(r[0], r[1][0], r[2][1] if r[2] else None) for r in right]
    want = {(a[0], b[0]) for a in left for b in flat if any(k and k == v for k, v in zip(a[1:], b[1:], strict=True))}
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_hot_values_are_dealt_to_many_tasks(spark):
    """No (value, block, block) holds much more than a block of either side, and rows of light values aren't repeated."""
    n, block = 3000, 100
    sides = [spark.range(n).select(F.struct("id").alias("row"), F.lit(0).alias("p"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("v")) for _ in range(2)]
    for side in joins._dealt(*sides, block):
        most = side.groupBy("p", "v", "i", "j").count().agg(F.max("count")).first()[0]
        assert most < 2 * block
        assert side.where("v <> 'hot'").count() == n - n // 3
        assert side.where("v = 'hot'").count() == n // 3 * 10


def test_empty_sides(spark):
    _, _, l_df, r_df = _sides(spark)
    for a, b in ((l_df.limit(0), r_df), (l_df, r_df.limit(0))):
        assert joins.array_membership_join(a, b, PAIRS, left_keep=["i"], right_keep=["row"]).isEmpty()
