"""Joins with guards against fan-out, and rewrites of joins that would be Cartesian."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class NotUnique(ValueError):
    """A dimension holds a key more than once."""


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a non-null key occurs twice: one aggregate, one row to the driver."""
    known = df.dropna(subset=list(keys))
    twice = known.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if twice:
        raise NotUnique(f"{list(keys)} repeat: {twice[0].asDict()}")


def enrich_left(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], *, check_unique: bool = True) -> DataFrame:
    """fact with dim's columns where the key is found; dim's key must be unique."""
    on = [on] if isinstance(on, str) else list(on)
    if check_unique:
        assert_unique(dim, on)
    return fact.join(dim, on, "left")


def full_outer_merge(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Two tables of one row a key as one; keys of either side."""
    return a.join(b, key, "full_outer")


#: Rows of one side that share a key value and meet in one task, about; a value of more rows is cut to blocks.
BLOCK = 1 << 14


def _keyed(df: DataFrame, keep: Sequence[str], keys: Column) -> DataFrame:
    """(row, p, v): the kept columns of each row with each of its keys, once; keys without a value are left out."""
    return df.select(F.struct(*keep).alias("row"), F.explode(keys).alias("k")).select("row", "k.p", "k.v").where("v IS NOT NULL").distinct()


def _dealt(left: DataFrame, right: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Both sides as (p, v, i, j, l) and (p, v, i, j, r), where rows with an equal key meet in one (p, v, i, j).

    A key of n rows has ceil(n / block) blocks on a side: a row stands in one block of its own side and once for each block of the other. So a
    key that many rows share on both sides, a third of all say, is multiplied by many tasks, and repeats rows only as far as the other side asks.
    """
    def blocks(side, name):
        return side.groupBy("p", "v").agg(F.count("*").alias("n")).where(F.col("n") > block).select("p", "v", F.ceil(F.col("n") / float(block)).cast("int").alias(name))

    cut = blocks(left, "of_l").join(blocks(right, "of_r"), ["p", "v"], "full_outer")
    of_l, of_r = F.coalesce("of_l", F.lit(1)), F.coalesce("of_r", F.lit(1))
    own = lambda k: F.pmod(F.xxhash64("row"), k).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), k - 1))
    return (
        left.join(cut, ["p", "v"], "left").select("p", "v", own(of_l).alias("i"), every(of_r).alias("j"), F.col("row").alias("l")),
        right.join(cut, ["p", "v"], "left").select("p", "v", every(of_l).alias("i"), own(of_r).alias("j"), F.col("row").alias("r")),
    )


def _matches(left: DataFrame, right: DataFrame, block: int) -> DataFrame:
    """Distinct pairs of rows that share a key, each with the columns of both."""
    l_side, r_side = _dealt(left, right, block)
    return l_side.join(r_side, ["p", "v", "i", "j"]).select("l.*", "r.*").distinct()


def array_membership_join(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], *, left_keep: Sequence[str], right_keep: Sequence[str], block: int = BLOCK) -> DataFrame:
    """Distinct rows that match when a left key is in a right array, over any of the (left key, right array) pairs.

    An OR of array_contains has no equality to hash on; here arrays are exploded to (pair, value) and joined on equality. Null keys, null arrays
    and null items match nothing; repeated rows count once; a value that more than ``block`` rows of a side hold is joined block by block.
    """
    l_side = _keyed(left, left_keep, F.array(*[_tagged(F.col(k).cast("string"), i) for i, (k, _) in enumerate(pairs)]))
    r_side = _keyed(right, right_keep, F.array_distinct(F.concat(*[_tag(a, i) for i, (_, a) in enumerate(pairs)])))
    return _matches(l_side, r_side, block)


def _tagged(value: Column, i: int) -> Column:
    return F.struct(F.lit(i).alias("p"), value.alias("v"))


def _tag(array: str, i: int) -> Column:
    return F.transform(F.coalesce(F.col(array).cast("array<string>"), F.array().cast("array<string>")), lambda v: _tagged(v, i))


def multi_bridge_join(left: DataFrame, right: DataFrame, bridges: Sequence[tuple[str, str]], *, left_keep: Sequence[str], right_keep: Sequence[str], block: int = BLOCK) -> DataFrame:
    """Distinct matches over any of the (left column, right column) bridges: keys stacked, one equality join.

    Null and empty values match nothing; a value that more than ``block`` rows of a side hold is joined block by block.
    """
    def stacked(df, keep, side):
        return _keyed(df, keep, F.array(*[_tagged(F.nullif(F.col(b[side]).cast("string"), F.lit("")), i) for i, b in enumerate(bridges)]))

    return _matches(stacked(left, left_keep, 0), stacked(right, right_keep, 1), block)


def unique_bridge(bridge: DataFrame, value: str, owner: str) -> DataFrame:
    """(value, owner, owners): every bridge value with its smallest owner and how many there are."""
    known = bridge.where(F.col(value).isNotNull() & F.col(owner).isNotNull())
    return known.groupBy(value).agg(F.min(owner).alias(owner), F.count_distinct(owner).alias("owners"))


def unique_bridge_join(left: DataFrame, bridge: DataFrame, value: str, owner: str) -> DataFrame:
    """left with the owner of its value where the value has one owner only."""
    return left.join(unique_bridge(bridge, value, owner).where("owners = 1").drop("owners"), value, "left")


def semi_exists(left: DataFrame, right: DataFrame, key: str, array: str) -> DataFrame:
    """Rows whose key is in any array of the right side."""
    values = right.select(F.explode(array).alias(key)).distinct()
    return left.join(values, key, "left_semi")


def last_access_pick(df: DataFrame, key: str, ts_col: str, keep: Sequence[str]) -> DataFrame:
    """The row of the latest ``ts_col`` for each key, as one aggregate."""
    best = F.max_by(F.struct(*keep, ts_col), F.struct(ts_col, *keep))
    return df.groupBy(key).agg(best.alias("b")).select(key, "b.*")
