"""Recency and share metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_of(as_of) -> Column:
    return F.lit(str(as_of)).cast("date")


def days_since_last(df: DataFrame, key: str, ts_col: str, *, as_of, where: Column | None = None) -> DataFrame:
    """(key, last_at, days): the latest qualifying event of each key."""
    df = df if where is None else df.where(where)
    return df.groupBy(key).agg(F.max(ts_col).alias("last_at")).withColumn("days", F.datediff(_as_of(as_of), F.col("last_at")))


def bucketize(col: Column, edges: Sequence, labels: Sequence[str]) -> Column:
    """The label of the first edge not below ``col``; the last label beyond all edges; null for null."""
    out = F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges, labels, strict=False))):
        out = F.when(col <= edge, label).otherwise(out)
    return F.when(col.isNotNull(), out)


def trailing_window(col: Column, as_of, days: int) -> Column:
    """Whether a date lies 0 to ``days`` days before ``as_of``."""
    return F.datediff(_as_of(as_of), col).between(0, days)


def epoch_guard(col: Column) -> Column:
    """``col`` as a date, without empty text and the default of 1970-01-01."""
    day = F.try_to_date(col.cast("string"))
    return F.when(day > F.lit("1970-01-01").cast("date"), day)


def missed_calls(df: DataFrame, key: str, event_id: str, ts_col: str, *, as_of, days: int = 14, where: Column | None = None, spine: DataFrame | None = None) -> DataFrame:
    """(key, missed): distinct qualifying events in the trailing window; 0 for the spine's other keys."""
    df = df if where is None else df.where(where)
    counts = df.where(trailing_window(F.col(ts_col), as_of, days)).groupBy(key).agg(F.count_distinct(event_id).alias("missed"))
    if spine is None:
        return counts
    return spine.select(key).distinct().join(counts, key, "left").select(key, F.coalesce("missed", F.lit(0)).alias("missed"))


def days_until_next(df: DataFrame, key: str, ts_col: str, *, as_of) -> DataFrame:
    """(key, next_at, days): the soonest event on or after ``as_of``."""
    ahead = df.where(F.to_date(ts_col) >= _as_of(as_of))
    return ahead.groupBy(key).agg(F.min(ts_col).alias("next_at")).withColumn("days", F.datediff(F.col("next_at"), _as_of(as_of)))


def booking_recency(df: DataFrame, email: str, uri: str, created: str, updated: str, *, as_of) -> DataFrame:
    """(email, last_booking_date, days): the latest creation of each normalised e-mail, each booking counted once by its URI."""
    from strata.operators.dedup import latest_per_key

    one = latest_per_key(df, [uri], [F.col(updated).desc_nulls_last(), F.col(created).desc_nulls_last()])
    one = one.withColumn("email", F.lower(F.trim(F.col(email)))).where("email <> ''")
    last = one.groupBy("email").agg(F.max(F.to_date(created)).alias("last_booking_date"))
    return last.withColumn("days", F.datediff(_as_of(as_of), F.col("last_booking_date")))


def days_since_login(leads: DataFrame, users: DataFrame, bridges: Sequence[tuple[str, str]], *, key: str, access: str, as_of) -> DataFrame:
    """(key, last_access, days, shown): latest access over all bridges (lead column, user column); ``3+ years`` past 1095 days."""
    from strata.operators.joins import multi_bridge_join

    users = users.withColumn("__access", epoch_guard(F.col(access)))
    hits = multi_bridge_join(leads, users.where("__access IS NOT NULL"), bridges, left_keep=[key], right_keep=["__access"])
    last = hits.groupBy(key).agg(F.max("__access").alias("last_access"))
    days = F.datediff(_as_of(as_of), F.col("last_access"))
    return last.select(key, "last_access", days.alias("days"), F.when(days > 1095, "3+ years").otherwise(days.cast("string")).alias("shown"))


def sentiment(spine: DataFrame, source: DataFrame, key: str, label: str, *, default: str = "NO_SENTIMENT") -> DataFrame:
    """Every key of the spine with its canonical label: trimmed, upper case, placeholders and absence as ``default``."""
    clean = F.upper(F.trim(F.col(label)))
    one = source.select(key, F.when(~clean.isin("", "\\N", "NONE", "NULL"), clean).alias("sentiment"))
    return enrich(spine, one, key).withColumn("sentiment", F.coalesce("sentiment", F.lit(default)))


def enrich(spine: DataFrame, one: DataFrame, key: str) -> DataFrame:
    return spine.select(key).distinct().join(one, key, "left")


def share_of_total(df: DataFrame, by: Sequence[str], within: Sequence[str] | None = None) -> DataFrame:
    """Rows of each group and their percentage of all rows, or of the rows that agree on ``within``."""
    counts = df.groupBy(*by).agg(F.count("*").alias("n"))
    if within:
        return counts.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(*within)), 2))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select(*by, "n", F.round(100.0 * F.col("n") / F.col("total"), 2).alias("pct"))


def concentration(df: DataFrame, by: str, flag: str) -> DataFrame:
    """Each group's failing rate beside the overall rate, and its shares of all failures and of all rows, in percent."""
    group = df.groupBy(by).agg(F.count("*").alias("total"), F.sum(F.col(flag).cast("long")).alias("failing"))
    whole = group.agg(F.sum("total").alias("t"), F.sum("failing").alias("f"))
    pct = lambda a, b: F.round(100.0 * F.col(a) / F.nullif(F.col(b), F.lit(0)), 1)
    return group.crossJoin(F.broadcast(whole)).select(
        by, "total", "failing", pct("failing", "total").alias("failing_pct"), pct("f", "t").alias("overall_pct"), pct("failing", "f").alias("share_of_failures"), pct("total", "t").alias("share_of_total"))
