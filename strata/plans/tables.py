"""Queries on dedup, joins, reshaping and schemas over the given tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions.predicates import any_array_element, like_length, not_in_list, text_any_match, text_none_match
from strata.operators import dedup, joins, quality, reshape, schema, triage
from strata.sources import incremental


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def latest_per_key(spark, d):
    return dedup.latest_per_key(read(spark, d, "events"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])


def byte_dedup(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "text")
    return dedup.byte_dedup(docs.unionByName(docs), "text", [F.col("doc_id")]).select("doc_id", "payload_hash")


def skip_known(spark, d):
    return dedup.skip_known(read(spark, d, "documents").select("doc_id", "source"), read(spark, d, "labels"), "doc_id")


def replay_filter(spark, d):
    return dedup.replay_filter(read(spark, d, "documents").select("doc_id", "source"), read(spark, d, "labels"), "doc_id")


def canonical_dedup(spark, d):
    return dedup.canonical_dedup(read(spark, d, "events"), "props", [F.col("ts"), F.col("event_id")]).select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


def version_distribution(spark, d):
    return dedup.version_distribution(read(spark, d, "events"), "user_id")


def cdc_filter(spark, d):
    events = read(spark, d, "events")
    wm = dedup.cdc_watermark(events.where("event_type = 'signup'"), "ts")
    return dedup.cdc_filter(events, "ts", wm).select("event_id", "ts")


def incremental_load(spark, d):
    events = read(spark, d, "events")
    return incremental.incremental_load(events, None, "ts", as_of="2024-01-31", first_run_days=7).select("event_id", "ts")


def dump_profile(spark, d):
    return incremental.dump_profile(read(spark, d, "orders").withColumn("day", F.to_date("o_orderdate")), "day")


def source_profile(spark, d):
    return incremental.source_profile(read(spark, d, "events"), "props", "ts")


def source_inventory(spark, d):
    """Sources that documents name, against those that a configuration, made of the first half of the documents, knows."""
    docs = read(spark, d, "documents").withColumn("table_name", F.concat_ws("/", "source", "lang"))
    known = docs.where(F.pmod("doc_id", F.lit(2)) == 0).groupBy(F.concat("table_name", F.when(F.col("lang") == "de", F.lit("-old")).otherwise(F.lit(""))).alias("source_table")).agg((F.count("*") > 3).alias("active"))
    return incremental.source_inventory(docs.select("table_name"), known)


def text_match(spark, d):
    docs = read(spark, d, "documents")
    words = ["licensed under", "threat", "MIT"]
    return docs.select("doc_id", text_any_match(F.col("text"), words).alias("hit"), text_none_match(F.col("text"), words).alias("miss"))


def predicates(spark, d):
    docs = read(spark, d, "documents").select("doc_id", "source", F.split("text", "\n").alias("lines"))
    return docs.select("doc_id", any_array_element(F.col("lines"), lambda x: F.length(x) < 20).alias("short_line"), like_length(F.col("source"), "src%", [4]).alias("one_digit"), not_in_list(F.col("source"), ["SRC0", "src1"]).alias("other"))


def enrich_left(spark, d):
    star = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice", "l_discount")
    for name, key, other in (("orders", "o_orderkey", {"o_custkey": "c_custkey"}), ("customer", "c_custkey", {"c_nationkey": "n_nationkey"}), ("nation", "n_nationkey", {"n_regionkey": "r_regionkey"}), ("region", "r_regionkey", {})):
        star = joins.enrich_left(star, read(spark, d, name), key).withColumnsRenamed(other)
    return star.groupBy("r_name", "c_mktsegment").agg(F.count("*").alias("n_lines"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


def full_outer_merge(spark, d):
    a = read(spark, d, "customer").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("customer_bal"))
    b = read(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count("*").alias("suppliers"), F.round(F.sum("s_acctbal"), 2).alias("supplier_bal"))
    return joins.full_outer_merge(a, b, "nationkey")


def array_membership_join(spark, d):
    arrays = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("supps"), F.collect_set("l_partkey").alias("parts"))
    suppliers = read(spark, d, "supplier").withColumn("s_code", F.col("s_suppkey") * 3)
    return joins.array_membership_join(suppliers, arrays, [("s_suppkey", "supps"), ("s_code", "parts")], left_keep=["s_suppkey"], right_keep=["l_orderkey"]).groupBy("s_suppkey").agg(F.count("*").alias("orders"))


def multi_bridge_join(spark, d):
    hits = joins.multi_bridge_join(read(spark, d, "supplier"), read(spark, d, "customer"), [("s_suppkey", "c_custkey"), ("s_name", "c_name"), ("s_acctbal", "c_acctbal")], left_keep=["s_suppkey"], right_keep=["c_custkey"])
    return hits


def unique_bridge_join(spark, d):
    bridge = read(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_suppkey")
    return joins.unique_bridge_join(read(spark, d, "part").select("p_partkey", "p_brand"), bridge, "p_partkey", "l_suppkey")


def semi_exists(spark, d):
    arrays = read(spark, d, "orders").where("o_orderstatus = 'P'").groupBy("o_custkey").agg(F.collect_set("o_custkey").alias("ids"))
    return joins.semi_exists(read(spark, d, "customer").select("c_custkey", "c_name"), arrays, "c_custkey", "ids")


def last_access_pick(spark, d):
    return joins.last_access_pick(read(spark, d, "events"), "user_id", "ts", ["event_id", "event_type"])


def explode_to_child(spark, d):
    return reshape.explode_to_child(read(spark, d, "embeddings"), "embedding", "embeddings", "vec_id", carry=["label"], position="pos").select("embeddings_vec_id", "label", "pos", F.col("value").cast("double").alias("value"))


def explode_children(spark, d):
    """Orders with a list of lines, each with a list of what it names: both child tables, one below the other."""
    things = F.array(F.struct(F.concat(F.lit("p"), "l_partkey").alias("id")), F.struct(F.concat(F.lit("s"), "l_suppkey").alias("id")))
    line = F.struct(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), things.alias("things"))
    orders = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))
    found = reshape.explode_children(orders, "lines", "orders", "l_orderkey")
    lines, named = found["orders_lines"], found["orders_lines_things"]
    return lines.select(F.lit("lines").alias("child"), F.col("orders_l_orderkey").cast("string").alias("parent"), "id").unionByName(named.select(F.lit("things").alias("child"), F.col("orders_lines_id").alias("parent"), "id"))


def explode_fragments(spark, d):
    turns = read(spark, d, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    return reshape.explode_fragments(turns, "turns", carry=["conv_id"], field="text")


def unpivot_arrays(spark, d):
    by = read(spark, d, "events").groupBy("user_id").agg(F.collect_list(F.when(F.col("event_type") == "click", F.struct(F.col("event_id").cast("string").alias("name"), F.col("value").cast("string").alias("email")))).alias("clicks"), F.collect_list(F.when(F.col("event_type") == "view", F.col("event_id").cast("string"))).alias("views"))
    return reshape.unpivot_arrays(by, ["clicks", "views"], carry=["user_id"]).select("user_id", "direction", "name")


def conditional_pivot(spark, d):
    return reshape.conditional_pivot(read(spark, d, "events"), "user_id", "event_type", "event_id", ["click", "error", "purchase", "signup", "view"])


def _maps(spark, d):
    counts = read(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return counts.groupBy("user_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("event_type", "n")))).alias("m"))


def pivot_map(spark, d):
    return reshape.pivot_map(_maps(spark, d), "m")


def map_to_rows(spark, d):
    return reshape.map_to_rows(_maps(spark, d), "m", carry=["user_id"])


def extract_map(spark, d):
    wide = read(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("cf_segment"), F.col("c_nationkey").alias("cf_nation"))
    return reshape.map_to_rows(reshape.extract_map(wide), "custom_fields", carry=["c_custkey"])


def parse_payload(spark, d):
    events = read(spark, d, "events").select("event_id", "props")
    parsed = schema.parse_payload(events, "props", schema.discover_schema(events, "props"))
    return schema.explode_payload(parsed.drop("props")).select("event_id", F.col("k").cast("bigint").alias("k"))


def cast_tree(spark, d):
    from pyspark.sql import types as T

    events = read(spark, d, "events").select("event_id", F.struct("user_id", "event_type", F.array("value").alias("vals")).alias("s"))
    target = T.StructType([T.StructField("event_type", T.StringType()), T.StructField("vals", T.ArrayType(T.StringType())), T.StructField("new", T.LongType())])
    got = events.select("event_id", schema.cast_tree(F.col("s"), events.schema["s"].dataType, target).alias("s"))
    return got.select("event_id", "s.event_type", F.col("s.vals")[0].cast("double").alias("value"), "s.new")


def schema_paths(spark, d):
    """A struct for each type of event, with a list of objects in it."""
    own = F.create_map("event_type", F.struct(F.col("event_id").alias("n"), F.array(F.struct("value")).alias("parts")))
    return schema.schema_paths(spark, schema.discover_schema(read(spark, d, "events").select(F.to_json(F.struct("user_id", own.alias("of"))).alias("j")), "j"))


def sentinel_nulls(spark, d):
    return schema.sentinel_nulls(read(spark, d, "customer"), ["building", "MACHINERY"]).select("c_custkey", "c_mktsegment")


def json_triage(spark, d):
    events = read(spark, d, "events").select("event_id", "props")
    kind = F.pmod("event_id", F.lit(5))
    raw = F.when(kind == 0, F.col("props")).when(kind == 1, F.replace("props", F.lit('"'), F.lit("'"))).when(kind == 2, F.regexp_replace("props", r"\}$", ",}")).when(kind == 3, F.translate("props", '"', "”")).otherwise(F.lit("{broken"))
    got = triage.json_triage(events.withColumn("raw", raw), "raw")
    return got.select("event_id", F.get_json_object("payload", "$.k").cast("bigint").alias("k"), "rung")


def rung_mix(spark, d):
    return triage.rung_mix(json_triage(spark, d))


def date_like_keys(spark, d):
    orders = read(spark, d, "orders").select(F.to_json(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderstatus", F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("padded"), "o_orderkey")).alias("j"))
    return triage.date_like_keys(orders, "j").withColumn("kind", F.lit("date")).unionByName(triage.leading_zero_keys(orders, "j").withColumn("kind", F.lit("zero")))


def find_join_keys(spark, d):
    names = ("lineitem", "orders", "customer", "part", "supplier", "nation")
    tables = {n: read(spark, d, n) for n in names}
    primary = {"orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey", "nation": "n_nationkey"}
    foreign = {"lineitem": ["l_orderkey", "l_partkey", "l_suppkey"], "orders": ["o_custkey"]}
    return quality.find_join_keys(tables, primary=primary, foreign=foreign)


def find_key(spark, d):
    rows = [(n, quality.find_key(read(spark, d, n), table=n)) for n in ("customer", "supplier", "part", "orders", "lineitem", "documents", "conversations")]
    return spark.createDataFrame(rows, "table_name string, key string")


_DEF = {
    "latest_per_key": "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "byte_dedup": "SELECT min(doc_id) AS doc_id, md5(text) AS payload_hash FROM documents GROUP BY md5(text)",
    "skip_known": "SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "replay_filter": "SELECT doc_id, source FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "canonical_dedup": "SELECT event_id, (props->>'k')::BIGINT AS k FROM events QUALIFY row_number() OVER (PARTITION BY props->>'k' ORDER BY ts, event_id) = 1",
    "version_distribution": "SELECT versions, count(*) AS keys FROM (SELECT count(*) AS versions FROM events GROUP BY user_id) GROUP BY versions",
    "cdc_filter": "SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'signup')",
    "incremental_load": "SELECT event_id, ts FROM events WHERE ts >= DATE '2024-01-31' - 7",
    "dump_profile": "SELECT o_orderdate::DATE AS ts, count(*) AS rows FROM orders GROUP BY 1",
    "source_profile": "SELECT count(*) AS rows, count(DISTINCT md5(props)) AS distinct_payloads, count(*) FILTER (props IS NULL) AS null_payloads, min(ts) AS first_ts, max(ts) AS last_ts, count(*) FILTER (json_valid(props)) AS parsed FROM events",
    "source_inventory": "WITH u AS (SELECT DISTINCT concat_ws('/', source, lang) AS t FROM documents), c AS (SELECT concat_ws('/', source, lang) || CASE WHEN lang = 'de' THEN '-old' ELSE '' END AS t, count(*) > 3 AS active FROM documents WHERE doc_id % 2 = 0 GROUP BY 1) SELECT coalesce(u.t, c.t) AS table_name, u.t IS NOT NULL AS in_source, coalesce(active, false) AS in_pipeline, CASE WHEN c.t IS NULL THEN 'new' WHEN u.t IS NULL THEN 'missing' ELSE 'known' END AS status FROM u FULL JOIN c ON u.t = c.t",
    "text_match": "SELECT doc_id, coalesce(text ILIKE '%licensed under%' OR text ILIKE '%threat%' OR text ILIKE '%mit%', false) AS hit, NOT coalesce(text ILIKE '%licensed under%' OR text ILIKE '%threat%' OR text ILIKE '%mit%', false) AS miss FROM documents",
    "predicates": "SELECT doc_id, coalesce(len(list_filter(string_split(text, chr(10)), lambda x: length(x) < 20)) > 0, false) AS short_line, source LIKE 'src%' AND length(source) = 4 AS one_digit, lower(source) NOT IN ('src0', 'src1') AS other FROM documents",
    "enrich_left": "SELECT r_name, c_mktsegment, count(*) AS n_lines, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL",
    "full_outer_merge": "SELECT coalesce(a.k, b.k) AS nationkey, customers, customer_bal, suppliers, supplier_bal FROM (SELECT c_nationkey AS k, count(*) AS customers, round(sum(c_acctbal), 2) AS customer_bal FROM customer GROUP BY 1) a FULL JOIN (SELECT s_nationkey AS k, count(*) AS suppliers, round(sum(s_acctbal), 2) AS supplier_bal FROM supplier GROUP BY 1) b ON a.k = b.k",
    "array_membership_join": "WITH a AS (SELECT DISTINCT l_orderkey, l_suppkey, l_partkey FROM lineitem) SELECT s_suppkey, count(DISTINCT l_orderkey) AS orders FROM (SELECT s_suppkey, l_orderkey FROM supplier JOIN a ON s_suppkey = l_suppkey UNION SELECT s_suppkey, l_orderkey FROM supplier JOIN a ON s_suppkey * 3 = l_partkey) GROUP BY s_suppkey",
    "multi_bridge_join": "SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON s_suppkey = c_custkey UNION SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON s_name = c_name UNION SELECT s_suppkey, c_custkey FROM supplier JOIN customer ON s_acctbal = c_acctbal",
    "unique_bridge_join": "SELECT p_partkey, p_brand, s AS l_suppkey FROM part LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS s FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) = 1) ON p_partkey = l_partkey",
    "semi_exists": "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')",
    "last_access_pick": "SELECT user_id, event_id, event_type, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC, event_type DESC) = 1",
    "explode_to_child": "SELECT vec_id AS embeddings_vec_id, label, (generate_subscripts(embedding, 1) - 1)::INT AS pos, unnest(embedding)::DOUBLE AS value FROM embeddings",
    "explode_children": "SELECT 'lines' AS child, l_orderkey::VARCHAR AS parent, l_orderkey || '-' || l_linenumber AS id FROM lineitem UNION ALL SELECT 'things', l_orderkey || '-' || l_linenumber, unnest(['p' || l_partkey, 's' || l_suppkey]) FROM lineitem",
    "explode_fragments": "SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1)::INT AS pos, text FROM conversations QUALIFY text IS NOT NULL",
    "unpivot_arrays": "SELECT user_id, CASE event_type WHEN 'click' THEN 'clicks' ELSE 'views' END AS direction, event_id::VARCHAR AS name FROM events WHERE event_type IN ('click', 'view')",
    "conditional_pivot": "SELECT user_id, " + ", ".join(f"coalesce(list_sort(list(DISTINCT event_id) FILTER (event_type = '{t}')), []) AS {t}" for t in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY user_id",
    "pivot_map": "SELECT user_id, " + ", ".join(f"nullif(count(*) FILTER (event_type = '{t}'), 0) AS {t}" for t in ("click", "error", "purchase", "signup", "view")) + " FROM events GROUP BY user_id",
    "map_to_rows": "SELECT user_id, event_type AS key, count(*) AS value FROM events GROUP BY ALL",
    "extract_map": "SELECT c_custkey, 'cf_segment' AS key, c_mktsegment AS value FROM customer WHERE c_mktsegment IS NOT NULL UNION ALL SELECT c_custkey, 'cf_nation', c_nationkey::VARCHAR FROM customer WHERE c_nationkey IS NOT NULL",
    "parse_payload": "SELECT event_id, (props->>'k')::BIGINT AS k FROM events",
    "cast_tree": "SELECT event_id, event_type, value, NULL::BIGINT AS new FROM events",
    "sentinel_nulls": "SELECT c_custkey, CASE WHEN lower(c_mktsegment) IN ('building', 'machinery') THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer",
    "json_triage": "SELECT event_id, CASE WHEN event_id % 5 < 4 THEN (props->>'k')::BIGINT END AS k, (['1', '3', '5', '1b', NULL])[event_id % 5 + 1] AS rung FROM events",
    "rung_mix": "SELECT (['1', '3', '5', '1b', NULL])[event_id % 5 + 1] AS rung, count(*) AS n FROM events GROUP BY ALL",
    "date_like_keys": "SELECT 'day' AS key, count(*) AS n, 'date' AS kind FROM (SELECT DISTINCT o_orderkey FROM orders) UNION ALL SELECT 'padded', count(*), 'zero' FROM (SELECT DISTINCT o_orderkey FROM orders)",
    "find_key": " UNION ALL ".join(f"SELECT '{t}' AS table_name, CASE {' '.join(f"WHEN count({c}) > 0 AND count({c}) = count(DISTINCT {c}) THEN '{c}'" for c in cs.split())} END AS key FROM {t}" for t, cs in {
        "customer": "c_custkey c_nationkey", "supplier": "s_suppkey s_nationkey", "part": "p_partkey", "orders": "o_orderkey o_custkey", "lineitem": "l_orderkey l_partkey l_suppkey", "documents": "doc_id", "conversations": "conv_id"}.items()),
    "schema_paths": "WITH t AS (SELECT DISTINCT event_type AS t FROM events), s AS (SELECT t, 'struct<n:bigint,parts:array<struct<value:double>>>' AS type FROM t) SELECT 'user_id' AS path, 'bigint' AS type, 'scalar' AS kind, false AS child_table UNION ALL SELECT 'of', 'struct<' || string_agg(t || ':' || type, ',' ORDER BY t) || '>', 'struct', false FROM s UNION ALL SELECT 'of.' || t, type, 'struct', false FROM s UNION ALL SELECT 'of.' || t || '.n', 'bigint', 'scalar', false FROM t UNION ALL SELECT 'of.' || t || '.parts', 'array<struct<value:double>>', 'array', true FROM t UNION ALL SELECT 'of.' || t || '.parts[].value', 'double', 'scalar', false FROM t",
    "find_join_keys": """
WITH fk AS (SELECT DISTINCT 'lineitem' AS t, 'l_orderkey' AS c, l_orderkey::BIGINT AS v FROM lineitem UNION SELECT 'lineitem', 'l_partkey', l_partkey FROM lineitem UNION SELECT 'lineitem', 'l_suppkey', l_suppkey FROM lineitem UNION SELECT 'orders', 'o_custkey', o_custkey FROM orders),
pk AS (SELECT 'orders' AS t, 'o_orderkey' AS c, o_orderkey AS v FROM orders UNION SELECT 'customer', 'c_custkey', c_custkey FROM customer UNION SELECT 'part', 'p_partkey', p_partkey FROM part UNION SELECT 'supplier', 's_suppkey', s_suppkey FROM supplier UNION SELECT 'nation', 'n_nationkey', n_nationkey FROM nation),
b AS (SELECT fk.t AS left_table, fk.c AS left_col, pk.t AS right_table, pk.c AS right_col, count(*) AS n FROM fk JOIN pk ON fk.v = pk.v AND fk.t <> pk.t GROUP BY ALL)
SELECT left_table, left_col, right_table, right_col, l.n AS left_n, r.n AS right_n, round(b.n / l.n, 4) AS containment FROM b
JOIN (SELECT t, c, count(*) AS n FROM fk GROUP BY ALL) l ON l.t = left_table AND l.c = left_col JOIN (SELECT t, c, count(*) AS n FROM pk GROUP BY ALL) r ON r.t = right_table AND r.c = right_col
WHERE l.n >= 30 AND round(b.n / l.n, 4) >= 0.9""",
}
_ALL = (
    latest_per_key, byte_dedup, skip_known, replay_filter, canonical_dedup, version_distribution, cdc_filter, incremental_load, dump_profile, source_profile, source_inventory, text_match, predicates, enrich_left, full_outer_merge,
    array_membership_join, multi_bridge_join, unique_bridge_join, semi_exists, last_access_pick, explode_to_child, explode_children, explode_fragments, unpivot_arrays, conditional_pivot, pivot_map, map_to_rows, extract_map, parse_payload, cast_tree,
    schema_paths, sentinel_nulls, json_triage, rung_mix, date_like_keys, find_join_keys, find_key,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLE = _DEF
