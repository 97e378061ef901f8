"""Tables that are kept up to date in place: keyed upserts, known hashes; and reads over JDBC."""

import glob
import os
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata.operators import dedup, upsert
from strata.sources import incremental


@pytest.fixture
def database(spark, tmp_path):
    name = f"kept_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield name
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def files(tmp_path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/db/t/**/*.parquet", recursive=True)}


def versions(spark, ids, day, **more):
    rows = spark.range(1).select(F.explode(F.array(*[F.lit(i).cast("bigint") for i in ids])).alias("id"))
    return rows.withColumns({"name": F.lit(f"day {day}"), "bronze_insert_date": F.lit(datetime(2024, 1, day)), "bronze_updated_at": F.lit(datetime(2024, 1, day))} | {k: F.lit(v) for k, v in more.items()})


def test_a_batch_rewrites_the_parts_of_its_keys_alone(spark, database, tmp_path):
    name = f"{database}.t"
    upsert.create_keyed(versions(spark, range(100), 1), name, "id", parts=8)
    before = files(tmp_path)
    assert len(before) == 8  # a file a part
    assert len(upsert.upsert_keyed(spark, name, versions(spark, [7], 2), "id")) == 1
    after = files(tmp_path)
    assert len(after) == 8 and len(before.items() & after.items()) == 7
    got = {r["id"]: (r["name"], r["bronze_insert_date"].day) for r in upsert.keyed_rows(spark, name).collect()}
    assert got == {i: ("day 1", 1) for i in range(100)} | {7: ("day 2", 1)}
    assert upsert.upsert_keyed(spark, name, versions(spark, [7], 2).where("false"), "id") == [] and files(tmp_path) == after


def test_keyed_upserts_equal_upserts_of_the_whole_and_may_be_repeated(spark, database):
    name = f"{database}.t"
    whole = versions(spark, range(60), 3)
    upsert.create_keyed(whole, name, "id", parts=8)
    for day, ids, more in [(4, range(50, 70), {}), (2, range(0, 20), {}), (5, [1, 2, 2, 64], {"extra": "x"}), (6, [3], {})]:
        batch = versions(spark, ids, day, **more).unionByName(versions(spark, [0], day, **more).withColumn("id", F.lit(None).cast("bigint")))
        whole = spark.createDataFrame(upsert.upsert_by_key(whole, batch, "id").collect(), upsert.upsert_by_key(whole, batch, "id").schema)
        for _ in range(2):
            upsert.upsert_keyed(spark, name, batch, "id")
        got = upsert.keyed_rows(spark, name).select(whole.columns)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def test_only_the_batch_is_shuffled(spark, database):
    name = f"{database}.t"
    upsert.create_keyed(versions(spark, range(100), 1), name, "id", parts=8)
    old = spark.table(name).where(F.col(upsert.PART).isin([1])).drop(upsert.PART)
    plan = upsert.upsert_by_key(old, spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("event_id").alias("id"), F.lit("x").alias("name"), F.current_timestamp().alias("bronze_updated_at")), "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("FullOuter") < plan.index("db/t") < plan.index("Exchange")  # none between the join and the table's scan
    assert "PartitionFilters: [isnotnull" in plan and plan.count("SelectedBucketsCount: 8") == 1


def test_null_keys_are_refused(spark, database):
    with pytest.raises(ValueError, match="quarantine"):
        upsert.create_keyed(versions(spark, [1], 1).withColumn("id", F.lit(None).cast("bigint")), f"{database}.t", "id")


def test_known_hashes_are_kept_and_not_shuffled(spark, database):
    name = f"{database}.t"
    batch = lambda *k: spark.createDataFrame([(x, i) for i, x in enumerate(k)], "h string, i int")
    dedup.create_known(batch("a", "b", "b", None), name, "h", buckets=8)
    assert [r["h"] for r in dedup.add_known(batch("b", "c", "c", None), name, "h").collect()] == ["c"]
    assert dedup.add_known(batch("b", "c", "c"), name, "h").collect() == []
    assert sorted(r["h"] for r in spark.table(name).collect()) == ["a", "b", "c"]
    assert sorted((r["h"] or "", r["i"]) for r in dedup.skip_kept(batch("a", "d", None, "d"), name, "h").collect()) == [("", 2), ("d", 1), ("d", 3)]
    plan = dedup.skip_kept(spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(F.col("event_type").alias("h")), name, "h")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("events.parquet") < plan.index("db/t")


def test_windows_of_batches():
    day = lambda n: datetime(2024, 1, n)
    small, large, one, null = [{"lo": a, "hi": b, "bytes": mb << 20} for a, b, mb in ((day(1), day(2), 10), (day(3), day(7), 256), (day(8), day(8), 900), (None, None, 1))]
    got = incremental.window_predicates([small, large, one, null], "at")
    assert got[0] == "at >= '2024-01-01 00:00:00' AND at <= '2024-01-02 00:00:00'" and got[-1] == "at IS NULL" and len(got) == 7
    assert got[1:3] == ["at >= '2024-01-03 00:00:00' AND at < '2024-01-04 00:00:00'", "at >= '2024-01-04 00:00:00' AND at < '2024-01-05 00:00:00'"]
    assert got[4] == "at >= '2024-01-06 00:00:00' AND at <= '2024-01-07 00:00:00'" and got[5] == "at >= '2024-01-08 00:00:00' AND at <= '2024-01-08 00:00:00'"


def test_jdbc_reads_each_row_once_and_pushes_filters(spark):
    url, properties = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.range(500).select("id", F.expr("timestampadd(HOUR, cast(id % 97 as int), timestamp'2024-01-01 00:00:00')").alias("at"))
    rows.write.jdbc(url, "ROWS_", properties=properties)
    packed = incremental.pack_batches(incremental.dump_profile(rows, "at"), row_bytes=1 << 20, budget_mb=100)
    got = incremental.jdbc_windows(spark, url, "ROWS_", packed, '"at"', properties=properties, split_mb=64)
    assert got.rdd.getNumPartitions() > len(packed) >= 5
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))
    assert "*GreaterThan(id,490)" in got.where("id > 490")._jdf.queryExecution().executedPlan().toString()
    assert incremental.jdbc_windows(spark, url, "ROWS_", [], '"at"', properties=properties).count() == 0
    one = incremental.jdbc_options(url, "ROWS_", ts_col='"at"', lo="2024-01-01 00:00:00", hi="2024-01-02 00:00:00", est_mb=1)
    assert incremental.jdbc_scan(spark, one | properties).count() == rows.where("at <= timestamp'2024-01-02 00:00:00'").count()
