"""Grouping, ranking, sampling and set operations with deterministic results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def group_counts(df: DataFrame, by: Sequence[str], value: str, *, digits: int = 2) -> DataFrame:
    """rows, distinct values, min, max, sum and mean of ``value`` for each group, in one pass over the groups."""
    v = F.col(value)
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct(v).alias("n_distinct"), F.min(v).alias("least"), F.max(v).alias("most"), F.round(F.sum(v), digits).alias("total"), F.round(F.avg(v), digits).alias("mean"))


def conditional_agg(df: DataFrame, by: Sequence[str], named: dict[str, tuple[Column, Column]]) -> DataFrame:
    """For each name (condition, value): the largest value among rows that meet the condition, all in one pass."""
    return df.groupBy(*by).agg(*[F.max(F.when(c, v)).alias(n) for n, (c, v) in named.items()])


def collect_set_sorted(df: DataFrame, by: Sequence[str], value: str, *, joined_by: str | None = None) -> DataFrame:
    """The sorted distinct values of each group, as an array or joined as text; for groups of bounded size."""
    values = F.array_sort(F.collect_set(value))
    return df.groupBy(*by).agg((F.array_join(values, joined_by) if joined_by is not None else values).alias("values"))


def having_filter(df: DataFrame, by: Sequence[str], *, least: int = 1, most: int | None = None) -> DataFrame:
    """Groups with ``least`` to ``most`` rows, and their size."""
    out = df.groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return out if most is None else out.where(F.col("n") <= most)


def rank_window(df: DataFrame, by: Sequence[str], order: Sequence[Column], *, most: int = 1, out: str = "rank") -> DataFrame:
    """The first ``most`` rows of each group by a total order; Spark limits each group before it shuffles."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(out) <= most)


def rank_then_filter(df: DataFrame, by: Sequence[str], order: Sequence[Column], where: Column) -> DataFrame:
    """Groups whose first row passes: the test sees no older versions."""
    return rank_window(df, by, order, out="__rank").drop("__rank").where(where)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows: each task keeps n, one task merges them."""
    return df.orderBy(*order).limit(n)


def seeded_sample(df: DataFrame, key: str, share: float, *, seed: int = 42) -> DataFrame:
    """About ``share`` of the rows by a hash of the key's text: the same rows in whatever order or partitions they come; null counts as no text."""
    h = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f"/{seed}"))), 1, 8), 16, 10).cast("bigint")
    return df.where(h < int(share * (1 << 32)))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts by column name; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_distinct(parts: Sequence[DataFrame]) -> DataFrame:
    return union_all(parts).distinct()


def cross_scalar(df: DataFrame, totals: DataFrame) -> DataFrame:
    """``df`` with the columns of a one-row aggregate, which is what is broadcast."""
    return df.crossJoin(F.broadcast(totals))


def self_join_versions(df: DataFrame, key: str, order: str, cols: Sequence[str]) -> DataFrame:
    """Each row beside the values of the version before it."""
    w = Window.partitionBy(key).orderBy(order)
    return df.select(key, order, *cols, *[F.lag(c).over(w).alias(f"old_{c}") for c in cols])
