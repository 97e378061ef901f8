"""Recency queries on events."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators.dedup import latest_per_key
from strata.operators.metrics import bucketize, days_since_last

AS_OF = "2024-01-31"


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def q_days_since_last(spark, sf_dir):
    events = latest_per_key(_read(spark, sf_dir, "events"), ["event_id"], [F.col("ts").desc_nulls_last()])
    days = days_since_last(events, "user_id", "ts", as_of=AS_OF, where=F.col("event_type") == "purchase")
    return days.select("user_id", "last_at", "days", bucketize(F.col("days"), [7, 14, 28], ["active", "cooling", "quiet", "lost"]).alias("band"))


QUERIES = {"days_since_last": q_days_since_last}
ORACLE = {
    "days_since_last": f"""
SELECT user_id, max(ts) AS last_at, date_diff('day', max(ts)::DATE, DATE '{AS_OF}')::INT AS days,
 CASE WHEN date_diff('day', max(ts)::DATE, DATE '{AS_OF}') <= 7 THEN 'active' WHEN date_diff('day', max(ts)::DATE, DATE '{AS_OF}') <= 14 THEN 'cooling'
 WHEN date_diff('day', max(ts)::DATE, DATE '{AS_OF}') <= 28 THEN 'quiet' ELSE 'lost' END AS band
FROM events WHERE event_type = 'purchase' GROUP BY user_id""",
}
