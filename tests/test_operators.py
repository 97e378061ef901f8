import json
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.graph import components
from strata.operators import dedup, history, identity, joins, metrics, quality, reshape, schema, scoring, triage, upsert
from strata.plans import parents
from strata.sources import incremental


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# triage: shapes of malformed JSON

SHAPES = [
    ("clean", '{"a": 1, "b": "it\'s"}', {"a": 1, "b": "it's"}, "1"),
    ("single quotes", "{'a': 'x', 'b': 2}", {"a": "x", "b": 2}, "3"),
    ("letter apostrophe", "{'a': 'it's fine'}", {"a": "it's fine"}, "3"),
    ("literals", "{'a': None, 'b': True, 'c': [False, None]}", {"a": None, "b": True, "c": [False, None]}, "3"),
    ("quoted literal stays", "{'a': 'None', 'b': 'x: True, y'}", {"a": "None", "b": "x: True, y"}, "3"),
    ("free text", "{'note': 'the dogs' toys, \"big\" ones', 'n': 1}", {"note": "the dogs' toys, \"big\" ones", "n": 1}, "4"),
    ("curly", "{“a”: “b”}", {"a": "b"}, "1b"),
    ("unquoted key", "{a: 1, b_c: [2]}", {"a": 1, "b_c": [2]}, "5"),
    ("raw tab", '{"a": "x\ty"}', {"a": "x\ty"}, "5"),
    ("trailing comma", '{"a": [1, 2,], }', {"a": [1, 2]}, "5"),
    ("bare backslash", '{"a": "c:\\dir"}', {"a": "c:\\dir"}, "5"),
    ("digit-leading value", '{"a": 12ab}', {"a": "12ab"}, "5"),
    ("leading zero", '{"a": 007}', None, None),
    ("null", None, None, None),
    ("empty", "", None, None),
    ("hopeless", "{'a': [1, 2", None, None),
    ("protected character", "{'a': '\ue000'}", None, None),
    ("comma in a string", '{"a": "x,}y", b: 1}', {"a": "x,}y", "b": 1}, "5"),
    ("lines", '{\n "a": 1,\n "b": 2,\n}', {"a": 1, "b": 2}, "5"),
    ("literal beside an apostrophe", '{"v": None, "t": "it\'s"}', {"v": None, "t": "it's"}, "3"),
    ("key pattern in a string", '{"a": "see, key: v", b: 1}', {"a": "see, key: v", "b": 1}, "5"),
    ("escaped backslash", '{"p": "C:\\\\Users", "q": 1,}', {"p": "C:\\Users", "q": 1}, "5"),
    ("curly single quotes", "{‘a’: ‘b’}", {"a": "b"}, "3"),
    ("free text twice", "[{'note': 'girls' night', 'n': 1}, {'note': 'boys' day', 'n': 2}]", [{"note": "girls' night", "n": 1}, {"note": "boys' day", "n": 2}], "4"),
    ("JSON text beside other keys", "{'a': 'x', 'p': '{\"id\": 1}'}", {"a": "x", "p": '{"id": 1}'}, "4"),
    ("form feed", '{"a": "x\x0cy\x01"}', {"a": "x\x0cy\x01"}, "5"),
    ("repeated keys", '{"a": 1, "b": {"c": 1, "c": 2}, "a": 3}', {"a": 3, "b": {"c": 2}}, "1"),
    ("repeated keys in single quotes", "{'a': None, 'a': 2}", {"a": 2}, "3"),
    ("double quotes in single ones", "{'a': 'say \"hi\"', 'b': None}", {"a": 'say "hi"', "b": None}, "4"),
    ("text after the value", '{"a": 1} {"b": 2}', None, None),
    ("bracket after the value", '{"a": 1}}', None, None),
    ("two values", "1, 2", None, None),
    ("its own end", '1],"w":5} x', None, None),
    ("tuple", "{'a': (1, None)}", None, None),
    ("wrapper of two keys", "{'a': '[1]', 'b': '[2]'}", {"a": "[1]", "b": "[2]"}, "3"),
    ("wrapper", "{'payload': '{\"id\": \"x\"}'}", {"id": "x"}, "2"),
    ("literals in a list of bare values", "[12ab, None, True, 3-4b]", ["12ab", None, True, "3-4b"], "5"),
    ("nested", '{"a": ' + "[" * 300 + "]" * 300 + "}", {"a": json.loads("[" * 300 + "]" * 300)}, "1"),
]


@pytest.mark.parametrize("name,raw,want,rung", SHAPES, ids=[s[0] for s in SHAPES])
def test_triage_shapes(spark, name, raw, want, rung):
    got = triage.json_triage(spark.createDataFrame([(raw,)], "raw string"), "raw", free_text_keys=["note"]).first()
    assert got["rung"] == rung
    assert (json.loads(got["payload"]) if got["payload"] else None) == want


def test_triage_takes_texts_of_any_length(spark):
    n = 60_000
    texts = {
        "literals": ("{'v': None, 'a': [" + ", ".join(["'x'"] * n) + "]}", "3"), "blanks": ('{"a": 1,' + " \n" * 300_000 + "}", "5"), "quotes": ('{"a": "' + '\\"' * 200_000 + '",}', "5"),
        "free": ("{'note': 'the dogs' toys " + "x 'y' " * 100_000 + "', 'n': 1}", "4"), "stray": ("{'" * 100_000, None), "keys": ("{" + ", ".join(f"k{i}: None" for i in range(n)) + "}", "5"), "backslashes": ('{"a": "' + "c:\\d " * 100_000 + '"}', "5"),
        "open": ('{"a": "' + "\\x" * 200_000, None), "numbers": ("[" + "1-2" * 100_000 + "]", None),
    }
    df = spark.createDataFrame([(k, t) for k, (t, _) in texts.items()], "name string, raw string")
    got = {r["name"]: r for r in triage.json_triage(df, "raw", free_text_keys=["note"]).select("name", "rung", F.length("payload").alias("n")).collect()}
    assert {k: r["rung"] for k, r in got.items()} == {k: rung for k, (_, rung) in texts.items()}


def test_triage_takes_linear_time(spark):
    texts = {"no end": lambda n: "{" + "'a':'[ " * n + "}", "escapes": lambda n: '{"' + '\\"' * (4 * n) + "\\", "ends": lambda n: "{" + ", ".join(f"'a{i}': '[\"x\"]'" for i in range(n // 2)) + "}", "free": lambda n: "{" + "'note': 'x' " * n, "braces": lambda n: "{'a': '" + "[ } " * n}
    df = spark.createDataFrame([(k, t(140_000)) for k, t in texts.items()], "name string, raw string").repartition(1)
    began = time.time()
    assert {r["name"]: r["rung"] for r in triage.json_triage(df, "raw", free_text_keys=["note"]).select("name", "rung").collect()} == {k: "4" if k == "ends" else None for k in texts}
    assert time.time() - began < 60  # about 10 s for five texts of a megabyte; the square of their length took hours


def test_triage_flags(spark):
    df = spark.createDataFrame([('{"a": 007, "d": 2024-01-02}',)], "raw string")
    got = triage.json_triage(df, "raw", quote_invalid_numbers=True, quote_bare_dates=True).first()
    assert json.loads(got["payload"]) == {"a": "007", "d": "2024-01-02"}


def test_envelopes(spark):
    cases = [('{"body": "{\\"x\\": 1}"}', {"x": 1}), ('{"items": [1, 2]}', [1, 2]), ('{"a": {"x": 1}, "b": 2}', {"a": {"x": 1}, "b": 2}), ('{"prose": "[not json"}', {"prose": "[not json"}), ('{"free": "{\\"x\\": 1}"}', {"free": '{"x": 1}'}), ('{"o": "{\\"body\\": \\"{\\\\\\"x\\\\\\": 2}\\"}"}', {"x": 2})]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, raw string")
    got = triage.unwrap_envelope(df, "raw", exempt_keys=["free"]).orderBy("i").collect()
    assert [json.loads(r["payload"]) for r in got] == [c[1] for c in cases]
    assert not any(r["wrapped"] for r in got)


def test_profiles_of_broken_json(spark):
    df = spark.createDataFrame([('{"a": "it\'s", "d": "2024-01-01", "z": "007", "l": "None"}',), ("{broken: ",)], "raw string")
    assert ("a", "apostrophe", 1) in rows(triage.breaker_profile(df, "raw")) and ("l", "bare_literal", 1) in rows(triage.breaker_profile(df, "raw"))
    assert rows(triage.date_like_keys(df, "raw")) == [("d", 1)] and rows(triage.leading_zero_keys(df, "raw")) == [("z", 1)]
    deep = spark.createDataFrame([('{"a": {"b": "it\'s None here", "d": ["01/31/2024", {"e": "02-30-2024", "f": "2024-01-01T00:00:00Z"}]}, "c": "x is None", "s": "{\\"i\\": \\"tab\\\\tso \\u2019\\"}", "l": ["it\'s", ["a\\"b"]]}',)] * 2, "raw string")
    assert rows(triage.breaker_profile(deep, "raw")) == sorted([("b", "apostrophe", 1), ("b", "bare_literal", 1), ("c", "bare_literal", 1), ("s", "quote", 1), ("s", "backslash", 1), ("s", "smart_quote", 1), ("i", "tab", 1), ("i", "smart_quote", 1), ("l", "apostrophe", 1), ("l", "quote", 1)])
    assert rows(triage.date_like_keys(deep, "raw")) == [("f", 1)]
    assert triage.needs_repair(df, "raw") and not triage.needs_repair(df.where("raw LIKE '%it%'"), "raw")
    assert rows(triage.problem_key_profile(triage.json_triage(df, "raw"), "raw")) == [("broken", None, 1)]


# upserts


def parent(spark, data, extra=""):
    return spark.createDataFrame(data, "id string, name string, bronze_insert_date timestamp, bronze_updated_at timestamp, payload_hash string" + extra)


def test_upsert_two_batches_and_replay(spark):
    d = [datetime(2024, 1, i) for i in range(1, 6)]
    empty = parent(spark, [])
    one = upsert.upsert_by_key(empty, parent(spark, [("1", "a", d[0], d[0], "h1"), ("2", "b", d[0], d[0], "h2")]), "id")
    batch = parent(spark, [("1", "old", d[1], d[1], "h3", "x"), ("1", "new", d[2], d[2], "h4", "y"), ("3", "c", d[2], d[2], "h5", "z"), (None, "n", d[2], d[2], "h6", "w")], ", extra string")
    good, bad = upsert.null_key_quarantine(batch, spark.createDataFrame([], "table_name string, pk_column string, payload_hash string, row_json string"), "id", table="t")
    two = upsert.upsert_by_key(one, good, "id")
    assert rows(two.select("id", "name", "extra", "bronze_insert_date")) == [("1", "new", "y", d[0]), ("2", "b", None, d[0]), ("3", "c", "z", d[2])]
    assert [r["payload_hash"] for r in bad.collect()] == ["h6"]
    assert rows(upsert.upsert_by_key(two, good, "id")) == rows(two)
    late = upsert.upsert_by_key(two, parent(spark, [("1", "late", d[3], d[0], "h7")]), "id")
    assert ("1", "new") in rows(late.select("id", "name"))
    clockless = upsert.upsert_by_key(parent(spark, [("1", "a", d[0], None, "h")]), parent(spark, [("1", "b", d[1], d[1], "h")]), "id")
    assert rows(clockless.select("id", "name")) == [("1", "b")]
    again, more = upsert.null_key_quarantine(batch, bad, "id", table="t")
    assert more.count() == 0 and again.count() == 3


def test_replace_table_and_sink(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS strata_t LOCATION '" + str(tmp_path / "db") + "'")
    name = "strata_t.people"
    upsert.table_sink(spark.createDataFrame([(1, "a")], "id int, v string"), name)
    upsert.replace_table(spark, name, spark.table(name).withColumn("w", F.lit(1)))
    upsert.table_sink(spark.createDataFrame([(2,)], "id int"), name)
    upsert.table_sink(spark.createDataFrame([(3, 9.5)], "id int, x double"), name)
    assert rows(spark.table(name).select("id", "v", "x")) == [(1, "a", None), (2, None, None), (3, None, 9.5)]
    with pytest.raises(ValueError):
        upsert.replace_table(spark, name, spark.table(name).drop("v"))
    spark.sql("DROP DATABASE strata_t CASCADE")


def test_write_route_raises_without_its_key(spark):
    with pytest.raises(ValueError):
        upsert.write_route(None, spark.range(2), key="nope")


# history


LEDGER = "id string, state string, days int, HASH_VALUE string, VRSN_START_DATE date, VRSN_END_DATE date"


def test_scd2_closes_opens_refreshes_and_repeats(spark):
    empty = spark.createDataFrame([], LEDGER)
    src = lambda *r: spark.createDataFrame(list(r), "id string, state string, days int")
    one = history.scd2_apply(empty, src(("a", "x", 1), ("b", "x", 1), ("c", "x", 1)), "id", ["id", "state"], ["days"], as_of="2024-01-01")
    two = history.scd2_apply(one, src(("a", "x", 9), ("b", "y", 9), (None, "x", 1), ("d", "x", 0)), "id", ["id", "state"], ["days"], as_of="2024-01-02")
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    cols = ["id", "state", "days", "VRSN_START_DATE", "VRSN_END_DATE"]
    want = [("a", "x", 9, d1, None), ("b", "x", 1, d1, d2), ("b", "y", 9, d2, None), ("c", "x", 1, d1, d2), ("d", "x", 0, d2, None)]
    assert rows(two.select(cols)) == sorted(want, key=repr)  # D8: the null id of the source closes nothing else, and c does close
    assert rows(history.scd2_apply(two, src(("a", "x", 9), ("b", "y", 9), ("d", "x", 0)), "id", ["id", "state"], ["days"], as_of="2024-01-02")) == rows(two)
    assert two.where("VRSN_END_DATE IS NULL").groupBy("id").count().where("count > 1").count() == 0
    assert rows(history.scd2_change_log(two, "id", "2024-01-02", ["state"]).select("id", "old_state", "new_state")) == [("b", "x", "y")]


def test_snapshots_replace_their_day_and_expire(spark, tmp_path):
    ledger = spark.createDataFrame([("a", "x", 1, "h", date(2024, 1, 1), None), ("b", "x", 1, "h", date(2024, 1, 1), date(2024, 1, 2))], LEDGER)
    h = history.daily_snapshot(None, ledger, as_of="2024-01-01")
    h = history.daily_snapshot(h, ledger, as_of="2024-03-01", keep_days=90)
    h = history.daily_snapshot(h, ledger, as_of="2024-03-01", keep_days=90)
    assert rows(h.select("run_date", "id")) == [(date(2024, 1, 1), "a"), (date(2024, 3, 1), "a")]
    assert rows(history.daily_snapshot(h, ledger, as_of="2024-05-01", keep_days=90).select("run_date")) == [(date(2024, 3, 1),), (date(2024, 5, 1),)]
    history.write_snapshot(h, str(tmp_path / "s"))
    history.write_snapshot(h.where("run_date = '2024-03-01'"), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2


def test_merge_map_goes_all_the_way_and_survives_cycles(spark):  # D9
    chain = [(i, i + 1) for i in range(1, 40)] + [(5, 5), (None, 3), (100, 101), (101, 102), (102, 100), (99, 101)]
    got = {r["loser"]: r for r in history.merge_map(spark.createDataFrame(chain, "l bigint, w bigint"), "l", "w").collect()}
    assert all(got[i]["root"] == 40 and got[i]["hops"] == 39 - i for i in range(1, 40))
    assert {got[i]["root"] for i in (99, 100, 101, 102)} == {100}
    leads = spark.createDataFrame([(i,) for i in (1, 2, 40, 50)], "id bigint")
    assert rows(history.merge_fold_report(leads, history.merge_map(spark.createDataFrame(chain[:39], "l bigint, w bigint"), "l", "w"), "id")) == [(4, 2, 2)]


# identity


def test_one_hop_and_closure(spark):  # D7
    e = spark.createDataFrame([("A", "e1"), ("B", "e1"), ("B", "e2"), ("C", "e2"), ("D", "e9"), ("E", None)], "hash string, email string")
    assert rows(identity.identity_groups(e, hops=1)) == [("A", "A"), ("B", "A"), ("C", "B"), ("D", "D"), ("E", "E")]
    assert rows(identity.identity_groups(e)) == [("A", "A"), ("B", "A"), ("C", "A"), ("D", "D"), ("E", "E")]
    wide = spark.createDataFrame([(f"n{i}", "shared") for i in range(6)] + [("n0", "own"), ("z", "own")], "hash string, email string")
    assert dict(rows(identity.identity_groups(wide)))["z"] == "n0" and dict(rows(identity.identity_groups(wide)))["n5"] == "n5"


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1200)] + [(7, 7), (None, 3)]
    got = dict(rows(components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in range(1000, 1200)} == {1000}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_dense_id_matches_rank(spark):  # D10
    df = spark.createDataFrame([(f"k{i * 37 % 101:03d}",) for i in range(300)], "k string")
    got = identity.dense_id(df, "k").distinct().orderBy("k").collect()
    assert [r["dense_id"] for r in got] == list(range(1, 102))


def test_staff_blocklist_roles_and_names(spark):
    spine = spark.createDataFrame([("g1", ["h1"], ["x@corp.com"], []), ("g2", ["h2"], ["me@home.org"], []), ("g3", ["h3"], ["reg@z.org"], []), ("g4", ["staff_9"], [], [])], "group_key string, hashes array<string>, real_emails array<string>, masked_emails array<string>")
    reg = spark.createDataFrame([(" REG@z.org",)], "email string")
    got = identity.staff_classify(spine, reg, domain="corp.com", marker_pattern="^staff_")
    assert {r["group_key"] for r in got.where("is_staff").collect()} == {"g1", "g3", "g4"}
    links = spark.createDataFrame([(1, "b@x", True, False), (1, "a@x", True, True), (1, "bad@x", True, True), (2, "c@x", False, False)], "owner int, v string, own boolean, real boolean")
    got = rows(identity.owner_blocklist(links, spark.createDataFrame([("bad@x",)], "v string"), owner="owner", value="v", own="own", real="real"))
    assert got == [(1, ["a@x", "b@x"], "a@x"), (2, ["c@x"], "c@x")]
    acts = spark.createDataFrame([(1, "Hey BRIAN, hi", None), (1, "Hi there, x", None), (2, "none", "Invitee:\n Ann Lee\n"), (2, "Hello Zoe!", None)], "k int, sms string, note string")
    got = identity.extract_names(acts, "k", [(F.col("note"), r"Invitee:\s*\n\s*([^\n]+)", False), (F.col("sms"), identity.GREETING, True)])
    assert rows(got) == [(1, "Brian", 2), (2, "Ann Lee", 1)]


def test_identities_are_normalised_once(spark):
    df = spark.createDataFrame([("h1", " A@X.org ", 1), ("h2", "", 2), (None, None, 3)], "h string, mail string, lead int")
    got = identity.collect_identities([identity.Branch(df, "s", "mail", {"hash": "h", "email": "mail", "lead_id": "lead"}), identity.Branch(df, "s", "mail", {"hash": "h", "email": "mail", "lead_id": "lead"})])
    assert rows(got.select("hash", "email", "lead_id")) == [("h1", "a@x.org", "1"), ("h2", None, "2")]


# joins


def test_joins_guard_against_fan_out(spark):
    fact, dim = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(joins.NotUnique):
        joins.enrich_left(fact, dim, "k")
    assert rows(joins.unique_bridge_join(fact, dim, "k", "v")) == [(1, None), (2, None)]


def test_membership_join_has_no_cartesian_product(spark):
    left = spark.createDataFrame([(1, "a", "z"), (2, None, "b")], "id int, k1 string, k2 string")
    right = spark.createDataFrame([(10, ["a", "q"], []), (11, None, ["b", "b"])], "rid int, a1 array<string>, a2 array<string>")
    got = joins.array_membership_join(left, right, [("k1", "a1"), ("k2", "a2")], left_keep=["id"], right_keep=["rid"])
    assert rows(got) == [(1, 10), (2, 11)]
    assert "Cartesian" not in got._jdf.queryExecution().toString()


# schema


def test_registry_union_never_loses_or_repeats_a_field(spark):
    reg = spark.createDataFrame([("t", "_type", "string"), ("t", "only_in_registry", "string"), ("t", "a b", "int"), ("u", "other", "int")], "silver_name string, field_name string, ddl_type string")
    s = T.StructType([T.StructField("_type", T.StringType()), T.StructField("name", T.StringType()), T.StructField("a_b", T.StringType())])
    assert [f.name for f in schema.registry_union(s, reg, "t")] == ["_type", "name", "a_b", "only_in_registry"]
    assert rows(schema.registry_audit(spark, reg, {"t": s}).select("field_name", "problem")) == [("a b", "orphan"), ("a_b", "unregistered"), ("name", "unregistered"), ("only_in_registry", "orphan"), ("other", "orphan")]


def test_discovery_covers_all_rows(spark):
    df = spark.createDataFrame([('{"a": 1}',)] * 50 + [('{"a": 2, "b": {"c": [1.5]}}',), ("broken",)], "j string")
    s = schema.discover_schema(df, "j")
    assert s["b"].dataType.simpleString() == "struct<c:array<double>>"
    assert schema.top_level_shape(df, "j") == "object"
    assert schema.descend_degraded(spark.createDataFrame([('[{"x": 1}, {"x": 2}]',)], "j string"), "j").simpleString() == "array<struct<x:bigint>>"
    assert [f.name for f in schema.variant_schema_to_struct("OBJECT<`a b`: BIGINT, `a_b`: STRING, c: VOID>")] == ["a_b", "a_b_2", "c"]


def test_cast_tree_and_drift(spark):  # D2: drift compares schemas, whatever the table's columns are
    df = spark.createDataFrame([(1, '{"x": 5}', ("p", 7), ["1", "z"])], "id int, t string, s struct<a:string,b:int>, l array<string>")
    target = T.StructType([T.StructField("t", T.DataType.fromDDL("struct<x:int>")), T.StructField("s", T.DataType.fromDDL("struct<b:string,c:int>")), T.StructField("l", T.DataType.fromDDL("array<int>")), T.StructField("id", T.StringType())])
    r = schema.reconcile_to_target(df, target).first()
    assert r["t"]["x"] == 5 and r["s"]["b"] == "7" and r["s"]["c"] is None and r["l"] == [1, None] and r["id"] == "1"
    got = rows(schema.nested_drift(spark, df.schema, target))
    assert ("s.a", "dropped", "string", None) in got and ("s.c", "added", None, "int") in got and ("id", "retyped", "int", "string") in got
    with pytest.raises(ValueError):
        schema.column_drop_guard(df.schema, target[:2])


# reshape


def test_flatten_explode_and_maps(spark):
    df = spark.createDataFrame([(1, ("x", (2,)), [("e1", 1), None, ("e2", 2)], {"k-1": "v", "k 1": "w"})], "id int, s struct<a:string,b:struct<c:int>>, arr array<struct<id:string,n:int>>, m map<string,string>")
    assert reshape.flatten_structs(df).columns == ["id", "s_a", "s_b_c", "arr", "m"]
    child = reshape.explode_to_child(df, "arr", "t", "id", carry=["s"])
    assert rows(child.select("t_id", "id", "n")) == [(1, "e1", 1), (1, "e2", 2)]
    assert reshape.pivot_map(df.select("id", "m"), "m").columns == ["id", "k_1", "k_1_2"]
    assert reshape.dedup_names(["a", "A", "a_2"]) == ["a", "A_2", "a_2_2"]
    mixed = spark.createDataFrame([(1, ['{"name": "n", "email": "e@x"}', "{Bob, b@x}", " plain@x "], [None])], "id int, x array<string>, y array<string>")
    assert rows(reshape.unpivot_arrays(mixed, ["x", "y"], carry=["id"])) == [(1, "x", "Bob", "b@x"), (1, "x", "n", "e@x"), (1, "x", "plain@x", None)]
    wide = spark.createDataFrame([(1, "v", [1, 2], None)], "id int, cf_a string, cf_b array<int>, cf_c string")
    assert reshape.extract_map(wide).first()["custom_fields"] == {"cf_a": "v", "cf_b": "[1,2]"}


# scoring: all 27 patterns of three flags


def test_engagement_pattern_truth_table(spark):
    values = [0, 1, None]
    table = [(a, b, c) for a in values for b in values for c in values]
    df = spark.createDataFrame(table, "a int, b int, c int")
    got = df.withColumn("p", scoring.engagement_pattern([F.col("a"), F.col("b"), F.col("c")])).collect()
    for r in got:
        on = tuple(int(bool(r[x])) for x in "abc")
        if on in scoring.PATTERNS:
            want = scoring.PATTERNS[on][0]
        else:
            want = "NO ENGAGEMENT" if sum(r[x] is None for x in "abc") <= 1 else "NO DATA"
        assert r["p"] == want, r


def test_money_and_bands(spark):
    df = spark.createDataFrame([("$1,200.50",), ("n/a",), (None,)], "v string").withColumn("m", scoring.money(F.col("v")))
    assert [r["m"] for r in df.collect()] == [1200.5, None, None]
    b = spark.range(4).withColumn("b", metrics.bucketize(F.when(F.col("id") < 3, F.col("id")), [0, 1], ["a", "b", "c"]))
    assert [r["b"] for r in b.orderBy("id").collect()] == ["a", "b", "c", None]


def test_status_is_tested_on_the_latest_version_only(spark):  # D6
    df = spark.createDataFrame([(1, 1, "active"), (1, 2, "closed"), (2, 1, "active")], "id int, v int, status string")
    latest = dedup.latest_per_key(df, ["id"], [F.col("v").desc()]).where("status = 'active'")
    assert rows(latest) == [(2, 1, "active")]


def test_booking_date_and_days_agree(spark):  # D5
    df = spark.createDataFrame([("u1", "a@x", datetime(2024, 1, 1)), ("u2", "A@x ", datetime(2024, 1, 9)), ("u2", "A@x ", datetime(2024, 1, 9))], "uri string, mail string, at timestamp")
    assert rows(metrics.booking_recency(df, "mail", "uri", "at", "at", as_of="2024-01-10")) == [("a@x", date(2024, 1, 9), 1)]


# quality


def test_deletion_drift_needs_no_hash_column(spark):  # D1
    df = spark.createDataFrame([("a", i) for i in range(1, 6)] + [("b", 1), ("b", 2)], "raw string, dump int")
    assert rows(quality.deletion_drift(df.withColumn("h", F.md5("raw")), "h", "dump", 3).select("last_seen")) == [(2,)]


def test_literal_leaks_and_guards(spark):  # D4
    df = spark.createDataFrame([("None", "x"), ("True", "y"), ("ok", None)], "a string, b string")
    assert rows(quality.literal_leaks(df)) == [("a", 2)]
    with pytest.raises(ValueError):
        quality.all_null_guard(df.select(F.lit(None).cast("string").alias("z")))
    quality.all_null_guard(df)
    assert quality.find_key(spark.createDataFrame([(1, "x"), (2, "x"), (None, "y")], "id int, t_id string"), table="t") == "id"
    assert quality.mapping_keys(spark.createDataFrame([(1, "x"), (2, "y")], "p int, q string"), ["p"]) == ["q"]


def test_fleet_health_finds_each_fault(spark):
    at = lambda d: datetime(2024, 1, d, 3)
    base = dict(run_id="r", bronze_table="b", mode="cdc", raw_rows=1, deduped_rows=1, cdc_rows=5, repair_needed=False, discovery_mode="full", fields_discovered=10, parsed_valid=5, parsed_null=0, quarantined_new=0, note=None, rung_stats='{"1": 90, "3": 10}')
    runs = [dict(base, silver_name="good", logged_at=at(d)) for d in range(1, 11)]
    runs += [dict(base, silver_name="empty", logged_at=at(d), cdc_rows=0 if d > 6 else 3) for d in range(1, 11)]
    runs += [dict(base, silver_name="stale", logged_at=at(2))]
    runs += [dict(base, silver_name="jump", logged_at=at(d), fields_discovered=10 if d < 10 else 2000, parsed_null=50 if d == 10 else 0, note="Type conflict: x" if d == 10 else None, rung_stats='{"1": 10, "3": 90}' if d == 10 else base["rung_stats"]) for d in (8, 9, 10)]
    runs += [dict(base, silver_name="storm", logged_at=at(10), mode="rebuild") for _ in range(4)]
    names = [f.split()[0] for f in parents.RUN_LOG.split(", ")]
    log = spark.createDataFrame([[r[n] for n in names] for r in runs], parents.RUN_LOG)
    q = spark.createDataFrame([("good", at(10))] * 51, "silver_name string, quarantined_at timestamp")
    expected = spark.createDataFrame([("good",), ("stale",), ("never",)], "silver_name string")
    formats = spark.createDataFrame([("good", "iso"), ("good", "date")], "silver_name string, format string")
    got = {(r["silver_name"], r["check"]) for r in quality.fleet_health(log, q, expected, as_of="2024-01-10 23:00:00", formats=formats).collect()}
    assert got == {("never", "missing run"), ("stale", "missing run"), ("empty", "empty streak"), ("stale", "stale"), ("jump", "parse rate"), ("jump", "field jump"), ("jump", "type conflict"), ("storm", "rebuild storm"), ("good", "quarantine flood"), ("jump", "rung shift"), ("jump", "field budget"), ("good", "time format")}


# sources and whole runs


def test_sources(spark):
    dumps = spark.createDataFrame([(i, n) for i, n in enumerate([100, 200, 900, 50, 60])], "ts int, rows bigint")
    got = incremental.pack_batches(dumps, row_bytes=1024, budget_mb=1)
    assert [(b["lo"], b["hi"]) for b in got] == [(0, 1), (2, 4)]
    o = incremental.jdbc_options("jdbc:x", "t", ts_col="at", lo="2024-01-01", hi="2024-01-02", est_mb=200)
    assert o["numPartitions"] == "3" and "WHERE at >=" in o["dbtable"] and "partitionColumn" not in incremental.jdbc_options("u", "t", ts_col="a", lo=1, hi=2, est_mb=10)
    conf = spark.createDataFrame([("a", "ta", True), ("b", "tb", True), ("c", "tc", False)], "source_table string, target_table string, active boolean")

    def load(r):
        if r["source_table"] == "b":
            raise OSError("down")
        return 7

    assert rows(incremental.load_all_sources(conf, load, fail=False).select("source_table", "status", "rows")) == [("a", "ok", 7), ("b", "failed", None)]
    with pytest.raises(RuntimeError):
        incremental.load_all_sources(conf, load)
    late = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 0, 5),), (datetime(2024, 1, 1, 0, 0, 0, 6),)], "ts timestamp")
    assert incremental.incremental_load(late, late.limit(1), "ts", as_of="2024-01-02").count() == 1


RAW = "raw_data string, insert_date timestamp, bronze_updated_at timestamp"


def test_process_table_end_to_end_and_replay(spark):  # D3
    d = [datetime(2024, 1, i) for i in range(1, 9)]
    cfg = parents.Config("b", "people", key="id", event_times=("date_updated",))
    raw = spark.createDataFrame([
        ('{"id": "1", "name": "a", "date_updated": "2024-01-01"}', d[0], d[0]), ('{"name": "a", "id": "1", "date_updated": "2024-01-01"}', d[1], d[1]), ("{'id': '2', 'name': 'b', 'date_updated': '2024-01-01'}", d[0], d[0]),
        ('{"id": null, "name": "n", "date_updated": "2024-01-01"}', d[0], d[0]), ("{hopeless", d[0], d[0]), ("{hopeless", d[1], d[1])], RAW)
    one = parents.process_table(raw, None, cfg)
    assert one.route == "full" and rows(one.table.select("id", "name")) == [("1", "a"), ("2", "b")]
    assert one.quarantined.count() == 1 and one.null_keys.count() == 1 and one.metrics["repair_needed"] and one.metrics["parsed_null"] == 1
    more = spark.createDataFrame([('{"id": "1", "name": "late", "date_updated": "2023-01-01"}', d[3], d[3]), ('{"id": "2", "name": "b2", "date_updated": "2024-02-01", "x": 1}', d[3], d[3])], RAW)
    two = parents.process_table(raw.unionByName(more), one.table, cfg)
    assert two.route == "upsert" and two.metrics["cdc_rows"] == 2
    assert rows(two.table.select("id", "name", "x")) == [("1", "a", None), ("2", "b2", 1)]
    parked = spark.createDataFrame([('{"id": "9", "name": "saved", "date_updated": "2020-01-01"}', d[0], d[0], "h9")], RAW + ", payload_hash string").withColumn("payload_hash", F.md5("raw_data"))
    table, left = parents.replay_quarantine(parked.unionByName(one.quarantined.select(parked.columns)), two.table, cfg)
    assert ("9", "saved") in rows(table.select("id", "name")) and left.count() == 1
    assert parents.rebuild_parent(raw, cfg, dry_run=True)["rows"] == 2
    done, log = parents.run_tables([(raw, None, cfg), (raw.limit(0), None, parents.Config("e", "none"))], run_id="r", logged_at="2024-01-09")
    assert set(done) >= {"people"} and log.count() == 2


def test_rebuild_child_counts_nulls(spark):
    p = spark.createDataFrame([(1, [("a",), None]), (2, None)], "id int, parts array<struct<t:string>>")
    assert parents.rebuild_child(p, "parts", "p", "id", dry_run=True) == {"planned": 2, "nulls": 1}
    assert rows(parents.rebuild_child(p, "parts", "p", "id")) == [(1, "a")]


def test_stream_upserts(spark, tmp_path):
    from strata.streaming.upserts import upsert_stream

    spark.sql("CREATE DATABASE IF NOT EXISTS strata_s LOCATION '" + str(tmp_path / "db") + "'")
    schema_ = T.StructType.fromDDL("id string, name string, bronze_insert_date timestamp, bronze_updated_at timestamp")
    for i, r in enumerate([("1", "a", datetime(2024, 1, 1), datetime(2024, 1, 1)), ("1", "b", datetime(2024, 1, 2), datetime(2024, 1, 2))]):
        spark.createDataFrame([r], schema_).write.mode("append").parquet(str(tmp_path / "in"))
        upsert_stream(spark, str(tmp_path / "in"), schema_, "strata_s.t", "id", checkpoint=str(tmp_path / "cp")).awaitTermination()
        assert rows(spark.table("strata_s.t").select("id", "name")) == [("1", "ab"[i])]
    spark.sql("DROP DATABASE strata_s CASCADE")
