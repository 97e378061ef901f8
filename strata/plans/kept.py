"""Queries on what is kept between runs: states of discovery, key maps, registries and lineage; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.shared import stage
from strata.operators import discovery, quality, schema, upsert
from strata.plans.landing import _table
from strata.plans.tables import read


def _payloads(spark, d) -> DataFrame:
    """Events as JSON: a field for each type, a number that is whole on some days, a list of objects, and a few texts that aren't JSON."""
    e = read(spark, d, "events").withColumn("day", F.dayofmonth("ts"))
    own = F.create_map("event_type", F.struct(F.col("event_id").alias("n"), F.when(F.col("day") > 20, F.lit("late")).alias("late")))
    mixed = F.when(F.col("day") < 10, F.col("event_id").cast("double") + 0.5).otherwise(F.col("value"))
    text = F.concat(F.lit('{"of": '), F.to_json(own), F.lit(', "m": '), F.when(F.col("day") < 10, F.col("user_id").cast("string")).otherwise(F.to_json(F.struct(mixed.alias("x")))), F.lit(', "l": '), F.to_json(F.array(F.struct("user_id"))), F.lit("}"))
    return e.select(F.to_date("ts").alias("at"), "day", F.when(F.pmod("event_id", F.lit(50)) == 3, F.lit("{oops")).otherwise(text).alias("j"))


def _state(spark, d) -> DataFrame:
    """The state of all payloads, folded from batches of ten days."""
    p, state = _payloads(spark, d), None
    for low in (1, 11, 21):
        batch = discovery.path_state(p.where(F.col("day").between(low, low + 9 + (low == 21))), "j", "at")
        state = stage(batch if state is None else discovery.fold_state(state, batch), "state")
    return state


def discovery_state(spark, d):
    return _state(spark, d)


def state_schema(spark, d):
    """The paths of the schema that the state gives."""
    return schema.schema_paths(spark, discovery.state_schema(_state(spark, d)))


def state_drift(spark, d):
    return discovery.state_drift(_state(spark, d), "2024-01-15")


def state_fields(spark, d):
    return discovery.state_fields(_state(spark, d))


def schema_sample(spark, d):
    """A day's payloads, and as many of the days before as make up 5000."""
    text = F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit(', "p": '), "props", F.lit("}"))
    p = read(spark, d, "events").select(F.dayofmonth("ts").alias("day"), text.alias("j"))
    return discovery.schema_sample(p.where("day = 21"), p.where("day < 21"), "j", 5000)


def key_map(spark, d):
    """Keys and what points to them, of all tables and one that carries its parent's key; kept as a table."""
    name = _table(spark)
    tables = {n: read(spark, d, n) for n in ("orders", "customer", "part", "supplier", "nation", "region")}
    tables["lineitem"] = read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    tables["customer_rich"] = tables["customer"].where("c_acctbal > 5000").select(F.col("c_custkey").alias("customer_id"), "c_nationkey")
    primary = {"orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey", "nation": "n_nationkey", "region": "r_regionkey", "customer_rich": "customer_id"}
    upsert.table_sink(quality.key_map(tables, primary=primary), name, mode="overwrite")
    got = stage(spark.table(name), "key-map")
    upsert.drop_table(spark, name)
    return got.drop("rel_hash")


def variant_schema_to_struct(spark, d):
    """The scalar paths of Spark's own schema of the events' variants, names sanitised and null alone as text."""
    text = F.to_json(F.create_map("event_type", F.struct("event_id", F.col("event_type").alias("the type"), F.col("user_id").alias("the_type"))))
    seen = read(spark, d, "events").agg(F.schema_of_variant_agg(F.parse_json(F.concat(F.lit('{"none": null, "of": '), text, F.lit("}")))).alias("s")).first()["s"]
    return schema.schema_paths(spark, schema.variant_schema_to_struct(seen)).where("kind = 'scalar'").select("path", "type")


def registry_audit(spark, d):
    """Fields that events are registered with, by name and by type of event, against those discovered."""
    e = read(spark, d, "events")
    found = schema.discover_schema(e.select(F.to_json(F.create_map("event_type", "value")).alias("j")), "j")
    registry = e.where("event_type <> 'click'").select(F.lit("events").alias("silver_name"), F.col("event_type").alias("field_name")).union(read(spark, d, "region").select(F.lit("events"), F.lower("r_name")))
    return schema.registry_audit(spark, registry, {"events": found})


def table_lineage(spark, d):
    """Tables named after regions, nations and a list of their customers."""
    nations = read(spark, d, "nation").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    names = [(r[0], r[1]) for r in nations.select(F.lower(F.translate("r_name", " ", "")), F.lower(F.translate("n_name", " ", ""))).collect()]  # 25 nations
    listed = read(spark, d, "nation").select("n_name").groupBy().agg(F.collect_list("n_name").alias("customers")).schema
    plain = read(spark, d, "nation").schema
    tables = {r: plain for r, _ in names} | {f"{r}_{n}": listed for r, n in names} | {f"{r}_{n}_customers": plain for r, n in names} | {f"{r}_{n}_customers_old": plain for r, n in names if n < "f"} | {f"{r}_custom": plain for r, _ in names}
    return quality.table_lineage(spark, tables)


def classify_columns(spark, d):
    """Columns of the events' discovered fields by kind: each type of event has a field of its kind."""
    kinds = F.when(F.length("event_type") < 5, F.to_json(F.create_map("event_type", "value"))).when(F.length("event_type") == 5, F.to_json(F.create_map("event_type", F.array("value")))).otherwise(F.to_json(F.create_map("event_type", F.struct("value"))))
    found = schema.discover_schema(read(spark, d, "events").select(kinds.alias("j")), "j")
    return spark.createDataFrame([(kind, c) for kind, cs in schema.classify_columns(found).items() for c in cs], "kind string, name string")


def field_budget(spark, d):
    log = read(spark, d, "events").groupBy(F.col("event_type").alias("silver_name"), F.to_date("ts").alias("day")).agg(F.countDistinct("user_id").alias("fields_discovered"))
    return quality.field_budget(log, 20)


_P = "WITH e AS (SELECT *, day(ts) AS d, ts::DATE AS seen FROM events), g AS (SELECT * FROM e WHERE event_id % 50 <> 3), s AS (SELECT '' AS path, CASE WHEN event_id % 50 = 3 THEN 'UNPARSED' ELSE 'OBJECT' END AS type, seen FROM e UNION ALL SELECT 'of', 'OBJECT', seen FROM g UNION ALL SELECT 'of.' || event_type, 'OBJECT', seen FROM g UNION ALL SELECT 'of.' || event_type || '.n', 'BIGINT', seen FROM g UNION ALL SELECT 'of.' || event_type || '.late', 'STRING', seen FROM g WHERE d > 20 UNION ALL SELECT 'm', CASE WHEN d < 10 THEN 'BIGINT' ELSE 'OBJECT' END, seen FROM g WHERE d < 10 OR d >= 10 UNION ALL SELECT 'm.x', 'DOUBLE', seen FROM g WHERE d >= 10 UNION ALL SELECT 'l', 'ARRAY', seen FROM g UNION ALL SELECT 'l[]', 'OBJECT', seen FROM g UNION ALL SELECT 'l[].user_id', 'BIGINT', seen FROM g), t AS (SELECT path, type, count(*) AS n, min(seen) AS first_day, max(seen) AS last_day FROM s GROUP BY ALL) "
_LATE = "bool_or(day(ts) > 20)"
_KEYS = [("customer", "c_custkey"), ("customer_rich", "customer_id"), ("nation", "n_nationkey"), ("orders", "o_orderkey"), ("part", "p_partkey"), ("region", "r_regionkey"), ("supplier", "s_suppkey")]
_COLUMNS = [*_KEYS, ("customer", "c_nationkey"), ("customer_rich", "c_nationkey"), ("lineitem", "l_orderkey"), ("lineitem", "l_partkey"), ("lineitem", "l_suppkey"), ("nation", "n_regionkey"), ("orders", "o_custkey"), ("supplier", "s_nationkey")]
_V = " UNION ".join(f"SELECT '{t}' AS t, '{c}' AS c, {c}::VARCHAR AS v FROM {t}" for t, c in _COLUMNS)

ORACLE = {
    "discovery_state": _P + "SELECT * FROM t",
    "state_schema": f"WITH g AS (SELECT event_type AS t, {_LATE} AS late FROM events WHERE event_id % 50 <> 3 GROUP BY 1), f AS (SELECT t, 'struct<' || CASE WHEN late THEN 'late:string,' ELSE '' END || 'n:bigint>' AS type FROM g) SELECT 'of' AS path, 'struct<' || string_agg(t || ':' || type, ',' ORDER BY t) || '>' AS type, 'struct' AS kind, false AS child_table FROM f UNION ALL SELECT 'of.' || t, type, 'struct', false FROM f UNION ALL SELECT 'of.' || t || '.n', 'bigint', 'scalar', false FROM f UNION ALL SELECT 'of.' || t || '.late', 'string', 'scalar', false FROM g WHERE late UNION ALL SELECT 'm', 'string', 'scalar', false UNION ALL SELECT 'l', 'array<struct<user_id:bigint>>', 'array', true UNION ALL SELECT 'l[].user_id', 'bigint', 'scalar', false",
    "state_drift": _P + "SELECT path, CASE WHEN min(first_day) >= '2024-01-15' THEN 'added' WHEN max(last_day) < '2024-01-15' THEN 'dropped' ELSE 'retyped' END AS change, string_agg(type, ',' ORDER BY type) AS types FROM t WHERE type <> 'UNPARSED' GROUP BY path HAVING bool_or(first_day >= '2024-01-15') OR max(last_day) < '2024-01-15'",
    "state_fields": _P + "SELECT path AS field, sum(n)::BIGINT AS n, round(sum(n) / (SELECT count(*) FROM events), 6) AS share FROM t WHERE path IN ('of', 'm', 'l') GROUP BY 1",
    "schema_sample": "WITH p AS (SELECT day(ts) AS d, '{\"id\": ' || event_id || ', \"p\": ' || props || '}' AS j FROM events), r AS (SELECT d, j, row_number() OVER (PARTITION BY d = 21 ORDER BY md5('42:' || j), j) AS i FROM p WHERE d <= 21), n AS (SELECT least(5000, count(*) FILTER (d = 21)) AS have FROM p) SELECT j FROM r, n WHERE i <= CASE WHEN d = 21 THEN have ELSE 5000 - have END",
    "key_map": f"WITH customer_rich AS (SELECT c_custkey AS customer_id, c_nationkey FROM customer WHERE c_acctbal > 5000), v AS ({_V}), w AS (SELECT DISTINCT t, c, v FROM v WHERE v IS NOT NULL), n AS (SELECT t, c, count(*) AS n FROM w GROUP BY ALL), k(t, c) AS (VALUES {', '.join(map(str, _KEYS))}), p AS (SELECT a.t AS lt, a.c AS lc, b.t AS rt, b.c AS rc, count(*) AS shared FROM w a JOIN w b ON a.v = b.v AND a.t <> b.t JOIN k ON k.t = b.t AND k.c = b.c GROUP BY ALL), q AS (SELECT p.*, a.n AS ln, b.n AS rn, shared / a.n AS s FROM p JOIN n a ON a.t = lt AND a.c = lc JOIN n b ON b.t = rt AND b.c = rc WHERE shared / a.n >= 0.9), "
    "o AS (SELECT row_number() OVER (ORDER BY q.lt, q.rt) AS i, q.lt, q.lc, q.rt, q.rc, ln, rn FROM q JOIN k ON k.t = lt AND k.c = lc WHERE ln < rn OR (ln = rn AND starts_with(lt, rt || '_')) ORDER BY lt, rt), "
    "g AS (WITH RECURSIVE r AS (SELECT 0::BIGINT AS i, []::VARCHAR[] AS gone, []::BIGINT[] AS taken UNION ALL SELECT o.i, CASE WHEN list_contains(gone, lt) OR list_contains(gone, rt) THEN gone ELSE list_append(gone, lt) END, CASE WHEN list_contains(gone, lt) OR list_contains(gone, rt) THEN taken ELSE list_append(taken, o.i) END FROM r JOIN o ON o.i = r.i + 1) SELECT gone, taken FROM r ORDER BY i DESC LIMIT 1), "
    "x AS (SELECT lt, lc, rt, rc, ln, rn FROM o, g WHERE list_contains(taken, i)) "
    "SELECT 'PK' AS kind, k.t AS left_table, k.c AS left_col, NULL AS right_table, NULL AS right_col, NULL::DOUBLE AS containment, n AS left_n, NULL::BIGINT AS right_n FROM k JOIN n USING (t, c) UNION ALL SELECT 'PK_ECHO', lt, lc, rt, rc, NULL, ln, rn FROM x UNION ALL SELECT 'PK_FK', lt, lc, rt, rc, round(s, 4), ln, rn FROM q, g WHERE ln >= 30 AND NOT list_contains(gone, rt)",
    "variant_schema_to_struct": "SELECT 'none' AS path, 'string' AS type UNION ALL SELECT DISTINCT unnest(['of.' || event_type || '.event_id', 'of.' || event_type || '.the_type', 'of.' || event_type || '.the_type_2']), unnest(['bigint', 'string', 'bigint']) FROM events",
    "registry_audit": "SELECT 'events' AS silver_name, lower(r_name) AS field_name, 'orphan' AS problem FROM region UNION ALL SELECT DISTINCT 'events', event_type, 'unregistered' FROM events WHERE event_type = 'click'",
    "table_lineage": "WITH n AS (SELECT lower(replace(r_name, ' ', '')) AS r, lower(replace(n_name, ' ', '')) AS n FROM nation JOIN region ON n_regionkey = r_regionkey) SELECT DISTINCT NULL AS parent, r AS child, 0 AS depth, NULL AS how FROM n UNION ALL SELECT r, r || '_' || n, 1, 'prefix' FROM n UNION ALL SELECT r || '_' || n, r || '_' || n || '_customers', 2, 'array' FROM n UNION ALL SELECT r || '_' || n || '_customers', r || '_' || n || '_customers_old', 3, 'prefix' FROM n WHERE n < 'f' UNION ALL SELECT DISTINCT r, r || '_custom', 1, 'custom' FROM n",
    "classify_columns": "SELECT DISTINCT CASE WHEN length(event_type) < 5 THEN 'scalars' WHEN length(event_type) = 5 THEN 'arrays' ELSE 'structs' END AS kind, event_type AS name FROM events",
    "field_budget": "SELECT silver_name, max(f) AS fields FROM (SELECT event_type AS silver_name, ts::DATE AS day, count(DISTINCT user_id) AS f FROM events GROUP BY ALL) GROUP BY 1 HAVING max(f) > 20",
}
QUERIES = {f.__name__: f for f in (discovery_state, state_schema, state_drift, state_fields, schema_sample, key_map, variant_schema_to_struct, registry_audit, table_lineage, classify_columns, field_budget)}
