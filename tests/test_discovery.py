"""Kept discovery, mixed lists, sketches of key columns, and key maps."""

import json
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import discovery, quality, schema


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


SHAPES = [
    {"a": 1, "b": {"c": "x", "d": [1, 2.5]}}, {"a": 2.5}, {"a": None, "b": None}, {"b": {"c": True, "e": {}}}, {"l": [{"x": 1}, {"y": [["z"]]}]}, {"l": []}, {"dot.ted": 1, "br[]": {"`q`": 2}, "": 3},
    {"m": [1, "x"]}, {"m": [{"k": 1}]}, {"b": {"c": "y", "d": "text"}}, {"n": 12345678901234567890}, {"p": [[1], [2.5], None]},
]


def payloads(spark, seed, n=60):
    rng = random.Random(seed)
    texts = [None, "{oops"] + [json.dumps(s) for s in SHAPES]
    return spark.createDataFrame([(rng.choice(texts), f"2024-01-{rng.randrange(1, 29):02d}") for _ in range(n)], "j string, d string").withColumn("d", F.col("d").cast("date"))


@pytest.mark.parametrize("seed", [1, 2])
def test_the_state_of_parts_is_the_state_of_the_whole(spark, seed):
    whole = payloads(spark, seed).withColumn("i", F.monotonically_increasing_id())
    parts = [discovery.path_state(whole.where(F.pmod("i", F.lit(3)) == k), "j", "d") for k in range(3)]
    state = discovery.path_state(whole, "j", "d")
    assert rows(discovery.fold_state(discovery.fold_state(parts[0], parts[1]), parts[2])) == rows(discovery.fold_state(parts[1], discovery.fold_state(parts[2], parts[0]))) == rows(state)
    assert discovery.state_schema(state) == schema.discover_schema(whole, "j")
    assert state.where("path = ''").agg(F.sum("n")).first()[0] == whole.count()


@pytest.mark.parametrize("shape", SHAPES, ids=lambda s: json.dumps(s)[:20])
def test_each_shape_gives_the_schema_that_discovery_finds(spark, shape):
    df = spark.createDataFrame([(json.dumps(shape), "2024-01-01")], "j string, d string")
    assert discovery.state_schema(discovery.path_state(df, "j", "d")) == schema.discover_schema(df, "j")


def test_nothing_to_discover(spark):
    empty = spark.createDataFrame([], "j string, d string")
    assert rows(discovery.path_state(empty, "j", "d")) == [] and discovery.state_schema(discovery.path_state(empty, "j", "d")) == schema.discover_schema(empty, "j")
    bad = discovery.path_state(spark.createDataFrame([("{", "2024-01-01"), (None, None)], "j string, d string"), "j", "d")
    assert [r["n"] for r in bad.collect()] == [2] and discovery.state_schema(bad).fields == []


def test_drift_of_a_state(spark):
    df = spark.createDataFrame([('{"a": 1, "b": 2}', "2024-01-01"), ('{"a": "x", "c": 3}', "2024-01-09")], "j string, d string")
    assert rows(discovery.state_drift(discovery.path_state(df, "j", "d"), "2024-01-05")) == [("a", "retyped", "BIGINT,STRING"), ("b", "dropped", "BIGINT"), ("c", "added", "BIGINT")]


def test_samples_are_topped_up_and_repeat(spark):
    batch, history = (spark.createDataFrame([(f'{{"{k}": {i}}}',) for i in range(n)] + [(None,)], "j string") for k, n in (("new", 10), ("old", 500)))
    got = rows(discovery.schema_sample(batch, history, "j", 50))
    assert len(got) == 50 and sum("new" in r[0] for r in got) == 10
    assert got == rows(discovery.schema_sample(batch.repartition(7), history.repartition(5), "j", 50)) != rows(discovery.schema_sample(batch, history, "j", 50, seed=1))
    few = discovery.schema_sample(history, batch, "j", 20)
    assert few.count() == 20 and few.where("j LIKE '%new%'").count() == 0
    assert {f.name for f in schema.discover_schema(discovery.schema_sample(batch, history, "j", 11), "j")} == {"new", "old"}
    assert discovery.schema_sample(batch, history, "j", 5000).count() == 510


def test_mixed_lists(spark):
    texts = ['[{"a": 1}, "x", null, 5, [1]]', '[{"b": {"c": 2}}]', "[]", None, "{}", "["]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, j string")
    found = discovery.discover_lists(df, "j")
    assert found.simpleString() == "array<struct<a:bigint,b:struct<c:bigint>,rest:string>>"
    got = {r["i"]: r["parsed"] for r in discovery.parse_lists(df, "j", found).collect()}
    assert [x and x.asDict(recursive=True) for x in got[0]] == [{"a": 1, "b": None, "rest": None}, {"a": None, "b": None, "rest": "x"}, None, {"a": None, "b": None, "rest": "5"}, {"a": None, "b": None, "rest": "[1]"}]
    assert got[1][0]["b"]["c"] == 2 and got[2] == [] and got[3] is got[4] is got[5] is None
    deep = spark.createDataFrame([('[[{"a": 1, "rest": 2}], [7]]',)], "j string")
    found = discovery.discover_lists(deep, "j")
    assert found.simpleString() == "array<array<struct<a:bigint,rest:bigint,rest_:string>>>"
    assert [[tuple(x) for x in y] for y in discovery.parse_lists(deep, "j", found).first()["parsed"]] == [[(1, 2, None)], [(None, None, "7")]]
    plain = spark.createDataFrame([("[1, 2]",), ("[3.5]",)], "j string")
    assert discovery.discover_lists(plain, "j").simpleString() == "array<double>"
    assert [r["parsed"] for r in discovery.parse_lists(plain, "j", discovery.discover_lists(plain, "j")).collect()] == [[1.0, 2.0], [3.5]]
    assert rows(discovery.element_votes(df, "j", levels=2)) == [(0, "array", 1), (0, "null", 1), (0, "object", 2), (0, "scalar", 2), (1, "scalar", 1)]
    with pytest.raises(ValueError, match="no lists"):
        discovery.discover_lists(spark.createDataFrame([("5",)], "j string"), "j")


def key_tables(spark):
    n = lambda k: spark.range(k).withColumnRenamed("id", "n")
    return {
        "lead": n(20000).select(F.col("n").alias("lead_id"), (F.col("n") % 100).alias("owner_id")), "owner": n(100).select(F.col("n").alias("owner_id")), "lead_custom": n(500).select(F.col("n").alias("lead_id"), (F.col("n") * 3).alias("csm")),
        "call": n(9000).select((F.col("n") + 100000).alias("call_id"), F.when(F.col("n") % 20 > 0, F.col("n") * 2 % 19000).otherwise(F.col("n") + 50000).alias("lead_id"), F.lit(" ").alias("none_id")),
        "other": n(300).select(F.concat(F.lit("o"), "n").alias("other_id"), F.concat(F.lit("p"), "n").alias("far_id")), "copy": n(300).select(F.concat(F.lit("o"), "n").alias("copy_id")),
    }


def test_key_map_finds_keys_echoes_and_pointers(spark):
    got = rows(quality.key_map(key_tables(spark)).select("kind", "left_table", "left_col", "right_table", "right_col"))
    kinds = {k: {r[1:] for r in got if r[0] == k} for k in ("PK", "PK_ECHO", "PK_FK")}
    assert {r[:2] for r in kinds["PK"]} == {("lead", "lead_id"), ("owner", "owner_id"), ("lead_custom", "lead_id"), ("call", "call_id"), ("other", "other_id"), ("copy", "copy_id")}
    assert kinds["PK_ECHO"] == {("lead_custom", "lead_id", "lead", "lead_id"), ("owner", "owner_id", "lead", "lead_id")}
    assert {("lead_custom", "csm", "lead", "lead_id"), ("call", "lead_id", "lead", "lead_id"), ("copy", "copy_id", "other", "other_id")} <= kinds["PK_FK"]
    assert not {r for r in kinds["PK_FK"] if r[1] in ("far_id", "none_id") or r[2] == "lead_custom"}


def test_sketches_drop_pairs_before_the_join_and_lose_none(spark):
    tables = key_tables(spark)
    primary, foreign = quality._key_columns(tables, None, None)
    left = set(quality._surviving(tables, primary, foreign, 0.9))
    every = [((t, c), (p, k)) for t, cs in foreign.items() for c in cs for p, k in primary.items() if p != t]
    exact = {((r["left_table"], r["left_col"]), (r["right_table"], r["right_col"])) for r in quality._containments(tables, every).where("shared >= 0.9 * left_n AND left_n > 0").collect()}
    assert exact <= left and len(left) < len(every) / 2
    assert (("other", "far_id"), ("other", "other_id")) not in left and (("call", "call_id"), ("lead", "lead_id")) not in left
    tops = quality.column_sketches(tables, {"lead": ["lead_id", "owner_id"]})
    assert 3500 < len(tops["lead", "lead_id"][1]) < 4700 and len(tops["lead", "owner_id"][1]) == 100


def test_lineage_by_name(spark):
    plain, listed = spark.range(1).schema, spark.range(1).select(F.array("id").alias("emails")).schema
    got = rows(quality.table_lineage(spark, {"lead": listed, "lead_emails": plain, "lead_emails_old": plain, "lead_custom": plain, "leads": plain}))
    assert got == sorted([(None, "lead", 0, None), ("lead", "lead_custom", 1, "custom"), ("lead", "lead_emails", 1, "array"), ("lead_emails", "lead_emails_old", 2, "prefix"), (None, "leads", 0, None)], key=repr)


def test_columns_by_kind(spark):
    s = spark.range(1).select("id", F.array("id").alias("l"), F.struct("id").alias("s"), F.create_map("id", "id").alias("m")).schema
    assert schema.classify_columns(s) == {"scalars": ["id"], "arrays": ["l"], "structs": ["s"], "maps": ["m"]}
