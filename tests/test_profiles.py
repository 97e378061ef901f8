"""Profiles of broken payloads, columns by rule, and the folder of staged tables."""

import os

from pyspark.sql import functions as F

from strata.functions import shared
from strata.operators import quality, reshape, triage


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_structure_profile(spark):
    texts = ['{"a": 1,}', '{"a": 1,}', " {\"a\": 1,} ", '{"a": [1, ], b : None}', "{'it': 'x, None]'}", '{"a": "x\\", b: ', '{"a" 1}', '{"a": "{b: None,}"}', "[NaN]", "", " ", None, "{“a”: 1}", ""]
    got = rows(triage.structure_profile(spark.createDataFrame([(t,) for t in texts], "breaker string"), "breaker"))
    assert got == [("bare_literal", 2), ("open_string", 1), ("other", 3), ("single_quote", 1), ("trailing_comma", 2), ("unquoted_key", 1)]
    assert rows(triage.structure_profile(spark.createDataFrame([], "j string"), "j")) == []


def test_structure_profile_of_long_texts(spark):
    long = spark.range(1).select(F.concat(F.lit("{"), F.repeat(F.lit("'a':'[ "), 150_000), F.lit("}")).alias("j"))
    assert ("open_string", 1) in rows(triage.structure_profile(long, "j")) or ("single_quote", 1) in rows(triage.structure_profile(long, "j"))


def test_derived_columns(spark):
    df = spark.createDataFrame([(1, " ", "b", 5), (2, None, None, -1), (3, "a", "", None)], "id int, x string, y string, n int")
    got = reshape.derived_columns(df, renamed={"key": "id"}, first_of={"best": ["x", "y"]}, joined={"X": ("-", ["x", "y", "n"])}, cases={"sign": [(F.col("n") < 0, "minus"), (F.col("n") > 4, F.col("y"))]})
    assert got.columns == ["y", "n", "key", "best", "X", "sign"]
    assert rows(got) == sorted([("b", 5, 1, "b", "b-5", "b"), (None, -1, 2, None, "-1", "minus"), ("", None, 3, "a", "a", None)], key=repr)


def test_checks_on_columns_of_any_name(spark):
    df = spark.createDataFrame([("{\"k\": 1}", None, 1), ("{\"k\": 2}", 2, 2)], "j string, k int, raw_fields int").select("j", "raw_fields", F.struct("k").alias("p"))
    assert rows(quality.type_conflicts(df, "j", "p")) == [("k", "lost", 1, 0.5)]
    seen = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", None)], "cut string, at int")
    assert rows(quality.deletion_drift(seen, "cut", "at", 2)) == [("a", 1)]
    assert quality.deletion_drift(seen, "cut", "at", 2).columns == ["cut", "last_seen"]


def test_scratch_deletes_what_was_staged(spark):
    with shared.scratch(spark) as made:
        with shared.scratch(spark):
            pass
        inner = shared.stage(spark.range(3), "kept")
        assert inner.count() == 3
        with shared.scratch(spark) as deeper:
            shared.stage(spark.range(2), "gone")
        assert len(deeper) == 1 and not os.path.exists(deeper[0].removeprefix("file:")) and inner.count() == 3
    assert len(made) == 2 and not any(os.path.exists(p.removeprefix("file:")) for p in made)
