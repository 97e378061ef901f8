"""Queries on raw dumps over the given tables, with their SQL: repair, quarantines, rebuilds, discovery, sinks and the helpers of sources."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.shared import stage
from strata.operators import dedup, discovery, identity, quality, reshape, schema, triage, upsert
from strata.plans import parents
from strata.plans.tables import read
from strata.sources import incremental


def _k(spark, d) -> DataFrame:
    """(event_id, k): the number that each event's JSON holds."""
    return read(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


def json_ladder(spark, d):
    """Every rung with its opt-ins: twelve shapes of the same record, one for each remainder of the id."""
    shapes = ['{{"k": {k}}}', "{{'k': {k}}}", '{{"k": {k},}}', "{{“k”: {k}}}", "{{'payload': '{{\"k\": {k}}}'}}", "{{'note': 'girls' night', 'k': {k}}}", "{{'p': '{{\"x\": 1}}', 'k': {k}}}", '{{k: {k}, z: 007}}', '{{"k": {k}, "d": 2024-01-02}}', "{{'k': {k}, 'a': None, 'b': [True, False], 'note': 'None'}}", '{{"k": 0, "k": {k}}}', "{{'k': {k}, 'x': 'so \"called\"', 'z': None}}"]
    raw = F.coalesce(*[F.when(F.pmod("event_id", F.lit(len(shapes))) == i, F.replace(F.lit(s.replace("{{", "{").replace("}}", "}")), F.lit("{k}"), F.col("k"))) for i, s in enumerate(shapes)])
    got = triage.json_triage(_k(spark, d).withColumn("raw", raw), "raw", free_text_keys=["note"], quote_invalid_numbers=True, quote_bare_dates=True)
    value = F.coalesce(*[F.get_json_object("payload", f"$.{x}") for x in ("note", "p", "z", "d", "x")])
    return got.select("event_id", F.try_variant_get(F.try_parse_json("payload"), "$.k", "bigint").alias("k"), "rung", value.alias("beside"))


def unwrap_envelope(spark, d):
    kind = F.pmod("event_id", F.lit(4))
    inner = F.to_json(F.struct(F.col("k").cast("bigint").alias("k")))
    raw = F.when(kind == 0, F.to_json(F.struct(inner.alias("payload")))).when(kind == 1, F.concat(F.lit('{"items": ['), "k", F.lit(", 0]}"))).when(kind == 2, inner).otherwise(F.to_json(F.struct(inner.alias("free"))))
    got = triage.unwrap_envelope(_k(spark, d).withColumn("raw", raw), "raw", exempt_keys=["free"])
    return got.select("event_id", F.coalesce(F.get_json_object("payload", "$.k"), F.get_json_object("payload", "$[0]")).cast("bigint").alias("k"), F.get_json_object("payload", "$.free").isNotNull().alias("stayed"), "wrapped")


def needs_repair(spark, d):
    events = read(spark, d, "events").select("event_type", F.when(F.col("event_type") == "error", F.replace("props", F.lit('"'), F.lit("'"))).otherwise(F.col("props")).alias("j"))
    rows = [(t, triage.needs_repair(events.where(F.col("event_type") == t), "j")) for t in ("click", "error")]
    return spark.createDataFrame(rows, "event_type string, repair boolean")


def problem_key_profile(spark, d):
    e = read(spark, d, "events")
    raw = F.when(F.pmod("event_id", F.lit(3)) == 0, F.concat(F.lit("{'note': 'girls' night', '"), "event_type", F.lit("': 1}"))).when(F.pmod("event_id", F.lit(3)) == 1, F.concat(F.lit("{'"), "event_type", F.lit("': [1, 2"))).otherwise(F.col("props"))
    return triage.problem_key_profile(triage.json_triage(e.select(raw.alias("raw")), "raw", free_text_keys=["note"]), "raw")


def structure_profile(spark, d):
    """Payloads broken in five ways, and whole ones, by the remainder of the id; strings hold what would be a breaker outside."""
    shapes = ['{"k": {k},}', "{k: {k}}", "{'k': {k}, 'a': None}", '{"k": {k}, "x": "no end', '{"k": {k} "x": "a: None,}"}', '{"k": {k}, "x": "{a: None,}"}']
    e = read(spark, d, "events")
    raw = F.coalesce(*[F.when(F.pmod("event_id", F.lit(len(shapes))) == i, F.replace(F.lit(s), F.lit("{k}"), F.col("event_id").cast("string"))) for i, s in enumerate(shapes)])
    return triage.structure_profile(e.select(raw.alias("raw")), "raw")


def breaker_profile(spark, d):
    """Texts two levels deep, and in a list."""
    docs = read(spark, d, "documents").where(~F.col("text").rlike(r"^\s*[\[{]"))
    return triage.breaker_profile(docs.select(F.to_json(F.struct(F.struct(F.struct("text").alias("page")).alias("body"), F.array(F.concat("source", F.lit("'s"))).alias("tags"))).alias("j")), "j")


def _raw(spark, d, *, broken: bool = False) -> DataFrame:
    """Events as raw dumps; a fifth in single quotes, and, if asked, some without a key and some that nothing can repair."""
    e = read(spark, d, "events")
    key = F.when(F.pmod("event_id", F.lit(11)) != 0, F.col("user_id")) if broken else F.col("user_id")
    j = F.to_json(F.struct(key.alias("id"), "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date_updated")))
    j = F.when(F.pmod("event_id", F.lit(5)) == 1, F.replace(j, F.lit('"'), F.lit("'"))).otherwise(j)
    if broken:
        j = F.when(F.pmod("event_id", F.lit(13)) == 0, F.concat(F.lit("{oops "), F.col("event_id").cast("string"))).otherwise(j)
    return e.select(j.alias("raw_data"), F.col("ts").alias("insert_date"), F.col("ts").alias("bronze_updated_at"))


_CFG = parents.Config("bronze_events", "events", key="id")


def process_table_repaired(spark, d):
    """Two runs: the first days fill the target, the second run repairs, quarantines and upserts what is newer."""
    raw = _raw(spark, d, broken=True)
    target = stage(parents.process_table(raw.where("insert_date < '2024-01-15'"), None, _CFG).table, "target")
    out = parents.process_table(raw, target, _CFG)
    table = out.table.select(F.lit("table").alias("part"), "event_id")
    bad = out.quarantined.select(F.lit("unparsed"), F.regexp_extract("raw_data", r"(\d+)", 1).cast("bigint"))
    null = out.null_keys.select(F.lit("no key"), F.get_json_object("row_json", "$.event_id").cast("bigint"))
    return table.union(bad).union(null)


def parse_quarantine(spark, d):
    """Unparsed payloads beside a quarantine that holds a half of them."""
    raw = _raw(spark, d, broken=True)
    parsed, _ = parents.parse_raw(raw, _CFG)
    held = parsed.where("rung IS NULL AND raw_data LIKE '%0'").drop("parsed")
    return upsert.parse_quarantine(parsed, held)[1].select("payload_hash", F.col("raw_data").alias("raw"))


def replay_quarantine(spark, d):
    """Rows with a free-text key are parked by a run that doesn't know the key, and replayed by one that does."""
    e = read(spark, d, "events")
    text = F.concat(F.lit("{'id': "), F.col("user_id"), F.lit(", 'event_id': "), F.col("event_id"), F.lit(", 'date_updated': '"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit("', 'note': 'girls' night'}")).otherwise(F.lit("', 'note': 'fine'}")))
    raw = e.select(text.alias("raw_data"), F.col("ts").alias("insert_date"), F.col("ts").alias("bronze_updated_at"))
    first = parents.process_table(raw, None, _CFG)
    table, rest = parents.replay_quarantine(stage(first.quarantined, "parked"), stage(first.table, "target"), parents.Config("bronze_events", "events", key="id", free_text_keys=["note"]))
    return table.select("id", "event_id", "note").union(rest.select(F.lit(-1).cast("bigint"), F.lit(-1).cast("bigint"), F.lit("still parked")))


def rebuild_parent(spark, d):
    raw = _raw(spark, d)
    counts = parents.rebuild_parent(raw, _CFG, dry_run=True)
    return parents.rebuild_parent(raw, _CFG).table.select("id", "event_id", F.lit(counts["raw_rows"]).alias("raw_rows"), F.lit(counts["rows"]).alias("planned"))


def rebuild_child(spark, d):
    lines = F.collect_list(F.struct("l_linenumber", "l_partkey"))
    parent = read(spark, d, "lineitem").groupBy("l_orderkey").agg(lines.alias("lines")).withColumn("lines", F.concat("lines", F.array(F.lit(None).cast("struct<l_linenumber:int,l_partkey:bigint>"))))
    plan = parents.rebuild_child(parent, "lines", "orders", "l_orderkey", dry_run=True)
    return parents.rebuild_child(parent, "lines", "orders", "l_orderkey").select("orders_l_orderkey", "l_linenumber", "l_partkey", F.lit(plan["planned"]).alias("planned"), F.lit(plan["nulls"]).alias("nulls"))


def run_tables(spark, d):
    """Two tables in one run; the second lacks its key, so its run is logged as failed."""
    raw = _raw(spark, d, broken=True)
    jobs = [(raw, None, _CFG), (raw, None, parents.Config("bronze_events", "others", key="nope"))]
    _, log = parents.run_tables(jobs, run_id="r1", logged_at="2024-02-01 00:00:00")
    return log.select("run_id", "silver_name", "mode", "cdc_rows", "parsed_valid", "parsed_null", "repair_needed", F.col("note").isNotNull().alias("failed"))


def _table(spark) -> str:
    return f"strata_{uuid.uuid4().hex}"


def full_replace(spark, d):
    """A table swapped for one that is made of it."""
    name, c = _table(spark), read(spark, d, "customer").select("c_custkey", "c_acctbal")
    upsert.table_sink(c, name, mode="overwrite")
    upsert.replace_table(spark, name, spark.table(name).where("c_acctbal > 0").withColumn("tier", F.floor(F.col("c_acctbal") / 1000).cast("bigint")))
    got = stage(spark.table(name), "replaced")
    upsert.drop_table(spark, name)
    return got


def table_sink(spark, d):
    """Two appends, the second with a column more and one less."""
    name, o = _table(spark), read(spark, d, "orders")
    upsert.table_sink(o.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey"), name)
    upsert.table_sink(o.where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderpriority"), name)
    got = stage(spark.table(name), "appended")
    upsert.drop_table(spark, name)
    return got


def collect_identities(spark, d):
    c = read(spark, d, "customer").withColumn("mail", F.concat(F.lit(" Customer"), (F.col("c_custkey") % 50).cast("string"), F.lit("@X.com ")))
    s = read(spark, d, "supplier")
    return identity.collect_identities([
        identity.Branch(c, "crm", "name", {"hash": F.when(F.col("c_acctbal") > 0, F.md5("c_name")), "lead_id": "c_custkey", "email": F.when(F.col("c_nationkey") > 3, F.col("mail"))}),
        identity.Branch(s, "platform", "id", {"hash": F.md5("s_name"), "contact_id": "s_suppkey"}),
    ])


def _spine(spark, d) -> DataFrame:
    """Customers of a nation and segment as one person."""
    c = read(spark, d, "customer")
    mail = F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 40 == 0, F.lit("@corp.com")).otherwise(F.lit("@x.com")))
    return c.groupBy(F.concat_ws("-", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("group_key")).agg(
        F.collect_set("c_custkey").alias("lead_ids"), F.collect_set(F.when(F.col("c_acctbal") > 0, mail)).alias("real_emails"), F.collect_set(F.when(F.col("c_acctbal") <= 0, mail)).alias("masked_emails"), F.collect_set(F.concat(F.lit("h"), F.col("c_custkey").cast("string"))).alias("hashes"))


def spine_coverage(spark, d):
    spine = _spine(spark, d).where("group_key NOT LIKE '%BUILDING'")
    return identity.spine_coverage(spine, read(spark, d, "orders"), [("o_custkey", "lead_ids")], event_id="o_orderkey")


def staff_classify(spark, d):
    registered = read(spark, d, "supplier").select(F.concat(F.lit(" C"), F.col("s_suppkey").cast("string"), F.lit("@x.com")).alias("email"))
    return identity.staff_classify(_spine(spark, d), registered, domain="corp.com", marker_pattern="^h1.*7$").select("group_key", "is_staff")


def discovered_fields(spark, d):
    """Discovery, the registry's memory and the shape of the payloads."""
    e = read(spark, d, "events").select(F.to_json(F.struct("event_id", "event_type", "value")).alias("j"))
    registry = read(spark, d, "region").select(F.lit("events").alias("silver_name"), F.lower("r_name").alias("field_name"), F.lit("string").alias("ddl_type"))
    registry = registry.union(schema.registry_rows(spark, "events", schema.discover_schema(e, "j")))
    got = schema.registry_union(schema.discover_schema(e, "j"), registry, "events")
    return schema.registry_rows(spark, "events", got).withColumn("shape", F.lit(schema.top_level_shape(e, "j")))


def nested_drift(spark, d):
    """What has come and gone between the events before the 20th and those from the 10th on: a field for each type and day."""
    e = read(spark, d, "events")
    field = F.concat_ws("_", "event_type", F.dayofmonth("ts").cast("string"))
    j = lambda df: df.select(F.to_json(F.create_map(field, F.struct(F.col("event_id").alias("n")))).alias("j"))
    old, new = (schema.discover_schema(j(e.where(w)), "j") for w in ("ts < '2024-01-20'", "ts >= '2024-01-10'"))
    return schema.nested_drift(spark, old, new)


def descend_degraded(spark, d):
    """Lists of objects, of texts and of lists: discovery alone takes their items for text."""
    e, kind = read(spark, d, "events"), F.pmod("event_id", F.lit(4))
    j = F.when(kind < 2, F.to_json(F.array(F.struct("event_id", "value")))).when(kind == 2, F.to_json(F.array("event_type"))).otherwise(F.to_json(F.array(F.array("user_id"))))
    e = e.select(j.alias("j"))
    return discovery.parse_lists(e, "j", discovery.discover_lists(e, "j")).select(F.explode("parsed").alias("p")).select("p.event_id", "p.value", "p.rest")


def flatten_structs(spark, d):
    c = read(spark, d, "customer").select("c_custkey", F.struct("c_name", F.struct("c_nationkey", "c_acctbal").alias("place")).alias("who"))
    return reshape.flatten_structs(c)


def explode_rows(spark, d):
    turns = read(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role", F.when(F.col("role") == "user", F.col("text")).alias("asked"))).alias("turns"))
    return reshape.explode_rows(turns, "turns", carry=["conv_id"], fields=["turn", "asked"])


def stamp_load_time(spark, d):
    stamped = incremental.stamp_load_time(read(spark, d, "events"), ts="2024-02-01 00:00:00")
    return stamped.groupBy("bronze_updated_at").agg(F.count("*").alias("n"))


def pack_batches(spark, d):
    days = incremental.dump_profile(read(spark, d, "orders").withColumn("month", F.trunc("o_orderdate", "month")), "month")
    packed = incremental.pack_batches(days, row_bytes=1 << 20, budget_mb=300)
    return spark.createDataFrame([(b["lo"], b["hi"], b["rows"]) for b in packed], "lo date, hi date, rows bigint")


#: An embedded database of the driver's own, in memory.
_DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def jdbc_scan(spark, d):
    """Events written to a database and read back in windows of days packed to a budget, the largest of them cut; a filter goes to the database."""
    url, ts = f"jdbc:derby:memory:{_table(spark)};create=true", '"day"'
    e = read(spark, d, "events").select("event_id", F.date_trunc("DAY", F.col("ts").cast("timestamp")).alias("day"), "event_type", "value")
    e.write.jdbc(url, "EVENTS", properties=_DERBY | {"batchsize": "10000"})
    days = incremental.dump_profile(spark.read.jdbc(url, "EVENTS", properties=_DERBY), "day")
    packed = incremental.pack_batches(days, row_bytes=1 << 16, budget_mb=128)
    return stage(incremental.jdbc_windows(spark, url, "EVENTS", packed, ts, properties=_DERBY).where("value > 50").select("event_id", "day", "event_type"), "jdbc")


def upsert_keyed(spark, d):
    """A table of each user's last event before the 20th, then that of every seventh user after: only their parts are rewritten."""
    name, e = _table(spark), read(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    order = [F.desc("ts"), F.desc("event_id")]
    upsert.create_keyed(dedup.latest_per_key(e.where("ts < '2024-01-20'"), ["user_id"], order), name, "user_id", parts=32)
    batch = dedup.latest_per_key(e.where("ts >= '2024-01-20' AND user_id % 7 = 0"), ["user_id"], order)
    upsert.upsert_keyed(spark, name, batch.withColumn("late", F.lit(True)), "user_id", event_time="ts", load_time="ts")
    got = stage(upsert.keyed_rows(spark, name), "upserted")
    upsert.drop_table(spark, name)
    return got


def skip_kept(spark, d):
    """Batches of payloads against a kept table of their hashes: what each brings that none before it had."""
    name, e = _table(spark), read(spark, d, "events").select("event_id", F.dayofmonth("ts").alias("day"), F.md5(F.concat_ws("|", "event_type", "props")).alias("payload_hash"))
    dedup.create_known(e.where("day < 10"), name, "payload_hash")
    parts = [dedup.add_known(e.where(w), name, "payload_hash").select("payload_hash", F.lit(n).alias("batch")) for n, w in enumerate(("day < 12", "day BETWEEN 12 AND 20", "day > 15"))]
    kept = stage(spark.table(name).select("payload_hash"), "kept")
    upsert.drop_table(spark, name)
    return kept.groupBy("payload_hash").agg(F.count("*").alias("held")).join(parts[0].unionByName(parts[1]).unionByName(parts[2]), "payload_hash", "left")


def load_all_sources(spark, d):
    config = read(spark, d, "region").select(F.col("r_name").alias("source_table"), F.lower("r_name").alias("target_table"), (F.col("r_regionkey") < 4).alias("active"), "r_regionkey")
    c = read(spark, d, "customer").join(read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))

    def load(row):
        if row["r_regionkey"] == 2:
            raise ValueError("no such source")
        return c.where(F.col("n_regionkey") == row["r_regionkey"]).count()

    return incremental.load_all_sources(config, load, fail=False).select("source_table", "target_table", "status", "rows", "error")


def key_profile(spark, d):
    e = read(spark, d, "events").select(F.to_json(F.struct("event_id", F.when(F.col("value") > 50, F.col("value")).alias("large"), F.when(F.col("event_type") == "click", F.lit(1)).alias("clicked"))).alias("j"))
    return incremental.key_profile(e, "j")


def shape_profile(spark, d):
    e = read(spark, d, "events").select(F.when(F.col("event_type") == "click", F.col("props")).when(F.col("event_type") == "view", F.to_json(F.array("value"))).when(F.col("event_type") == "error", F.lit("{")).otherwise(F.col("value").cast("string")).alias("j"))
    return incremental.shape_profile(e, "j")


def mapping_keys(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderkey").alias("o_parent"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("o_code"))
    return spark.createDataFrame([(x,) for x in quality.mapping_keys(o, inherited=["o_parent"])], "key string")


def open_versions(spark, d):
    """Contract checks over a ledger: a key and a start are unique, and a key has one open version."""
    e = read(spark, d, "events").select("user_id", "event_type", F.to_date("ts").alias("starts"))
    ledger = e.withColumn("ends", F.when(F.pmod(F.dayofmonth("starts"), F.lit(4)) != 0, F.date_add("starts", 1)))
    open_ = ledger.where("ends IS NULL")
    return upsert.contract_checks(ledger, not_null=["starts"], unique=[["user_id", "starts"]], checks={"order": F.col("ends") > F.col("starts")}).unionByName(
        upsert.contract_checks(open_, unique=[["user_id"]]).withColumn("rule", F.lit("one open version: user_id")))


_LATEST = "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"
_PARENT = "WITH v AS (SELECT *, CASE WHEN event_id % 11 <> 0 THEN user_id END AS id FROM events WHERE event_id % 13 <> 0)"
_MAIL = "'c' || c_custkey || CASE WHEN c_custkey % 40 = 0 THEN '@corp.com' ELSE '@x.com' END"
_BREAKS = {"apostrophe": "contains(t, '''')", "quote": "contains(t, '\"')", "backslash": "contains(t, chr(92))", "newline": "contains(t, chr(10))", "tab": "contains(t, chr(9))", "smart_quote": "regexp_matches(t, '[‘’“”]')", "bare_literal": r"regexp_matches(t, '\b(None|True|False|NaN|undefined)\b')"}

ORACLE = {
    "json_ladder": "SELECT event_id, (props->>'k')::BIGINT AS k, (['1', '3', '5', '1b', '2', '4', '4', '5', '5', '3', '1', '4'])[event_id % 12 + 1] AS rung, CASE event_id % 12 WHEN 5 THEN 'girls'' night' WHEN 6 THEN '{\"x\": 1}' WHEN 7 THEN '007' WHEN 8 THEN '2024-01-02' WHEN 9 THEN 'None' WHEN 11 THEN 'so \"called\"' END AS beside FROM events",
    "unwrap_envelope": "SELECT event_id, CASE WHEN event_id % 4 < 3 THEN (props->>'k')::BIGINT END AS k, event_id % 4 = 3 AS stayed, false AS wrapped FROM events",
    "needs_repair": "SELECT event_type, bool_or(NOT json_valid(CASE WHEN event_type = 'error' THEN replace(props, '\"', '''') ELSE props END)) AS repair FROM events WHERE event_type IN ('click', 'error') GROUP BY 1",
    "problem_key_profile": "SELECT event_type AS key, CASE event_id % 3 WHEN 0 THEN '4' END AS rung, count(*) AS n FROM events WHERE event_id % 3 < 2 GROUP BY ALL UNION ALL SELECT 'note', '4', count(*) FROM events WHERE event_id % 3 = 0",
    "structure_profile": "SELECT unnest(CASE event_id % 6 WHEN 0 THEN ['trailing_comma'] WHEN 1 THEN ['unquoted_key'] WHEN 2 THEN ['bare_literal', 'single_quote'] WHEN 3 THEN ['open_string'] WHEN 4 THEN ['other'] ELSE [] END) AS breaker, count(DISTINCT event_id) AS n FROM events GROUP BY 1",
    "breaker_profile": "WITH p AS (SELECT DISTINCT text, source FROM documents WHERE NOT regexp_matches(text, '^\\s*[\\[{]')), t AS (SELECT 'text' AS key, text AS t FROM p UNION ALL SELECT 'tags', source || '''s' FROM p), b AS (" + " UNION ALL ".join(f"SELECT key, '{n}' AS breaker FROM t WHERE {w}" for n, w in _BREAKS.items()) + ") SELECT key, breaker, count(*) AS n FROM b GROUP BY ALL",
    "process_table_repaired": _PARENT + ", w AS (SELECT max(ts) AS wm FROM (SELECT * FROM v WHERE id IS NOT NULL AND ts < '2024-01-15' " + _LATEST + ")) SELECT 'table' AS part, event_id FROM (SELECT * FROM v WHERE id IS NOT NULL " + _LATEST + ") UNION ALL SELECT 'unparsed', event_id FROM events, w WHERE event_id % 13 = 0 AND ts > wm UNION ALL SELECT 'no key', event_id FROM v, w WHERE id IS NULL AND ts > wm",
    "parse_quarantine": "SELECT md5('{oops ' || event_id) AS payload_hash, '{oops ' || event_id AS raw FROM events WHERE event_id % 13 = 0 AND event_id % 10 <> 0",
    "replay_quarantine": "SELECT user_id AS id, event_id, CASE WHEN event_id % 3 = 0 THEN 'girls'' night' ELSE 'fine' END AS note FROM events " + _LATEST,
    "rebuild_parent": "SELECT user_id AS id, event_id, (SELECT count(*) FROM events) AS raw_rows, (SELECT count(DISTINCT user_id) FROM events) AS planned FROM events " + _LATEST,
    "rebuild_child": "SELECT l_orderkey AS orders_l_orderkey, l_linenumber, l_partkey, (SELECT count(*) + count(DISTINCT l_orderkey) FROM lineitem) AS planned, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS nulls FROM lineitem",
    "run_tables": "SELECT 'r1' AS run_id, 'events' AS silver_name, 'full' AS mode, count(*) AS cdc_rows, count(*) FILTER (event_id % 13 <> 0) AS parsed_valid, count(*) FILTER (event_id % 13 = 0) AS parsed_null, true AS repair_needed, false AS failed FROM events UNION ALL SELECT 'r1', 'others', NULL, NULL, NULL, NULL, NULL, true",
    "full_replace": "SELECT c_custkey, c_acctbal, floor(c_acctbal / 1000)::BIGINT AS tier FROM customer WHERE c_acctbal > 0",
    "table_sink": "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders",
    "collect_identities": "SELECT DISTINCT * FROM (SELECT CASE WHEN c_acctbal > 0 THEN md5(c_name) END AS hash, c_custkey::VARCHAR AS lead_id, NULL::VARCHAR AS contact_id, NULL::VARCHAR AS activity_id, CASE WHEN c_nationkey > 3 THEN 'customer' || c_custkey % 50 || '@x.com' END AS email, 'crm' AS source, 'name' AS \"column\" FROM customer UNION ALL SELECT md5(s_name), NULL, s_suppkey::VARCHAR, NULL, NULL, 'platform', 'id' FROM supplier) WHERE hash IS NOT NULL OR email IS NOT NULL",
    "spine_coverage": "SELECT (SELECT count(DISTINCT o_orderkey) FROM orders) AS events, count(DISTINCT o_orderkey) AS reached, count(DISTINCT (c_nationkey, c_mktsegment)) AS people FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment <> 'BUILDING'",
    "staff_classify": f"SELECT c_nationkey || '-' || c_mktsegment AS group_key, bool_or(c_custkey % 40 = 0 OR {_MAIL} IN (SELECT 'c' || s_suppkey || '@x.com' FROM supplier) OR regexp_matches('h' || c_custkey, '^h1.*7$')) AS is_staff FROM customer GROUP BY 1",
    "discovered_fields": "SELECT 'events' AS silver_name, name AS field_name, type AS ddl_type, 'object' AS shape FROM (SELECT 'event_id' AS name, 'bigint' AS type UNION ALL SELECT 'event_type', 'string' UNION ALL SELECT 'value', 'double' UNION ALL SELECT lower(r_name), 'string' FROM region)",
    "nested_drift": "WITH f AS (SELECT event_type || '_' || day(ts) AS f, bool_or(ts < '2024-01-20') AS a, bool_or(ts >= '2024-01-10') AS b FROM events GROUP BY 1), c AS (SELECT f, CASE WHEN b THEN 'added' ELSE 'dropped' END AS change FROM f WHERE a <> b), p AS (SELECT f AS path, change, 'struct<n:bigint>' AS t FROM c UNION ALL SELECT f || '.n', change, 'bigint' FROM c) SELECT path, change, CASE WHEN change = 'dropped' THEN t END AS old_type, CASE WHEN change = 'added' THEN t END AS new_type FROM p",
    "descend_degraded": "SELECT CASE WHEN event_id % 4 < 2 THEN event_id END AS event_id, CASE WHEN event_id % 4 < 2 THEN value END AS value, CASE event_id % 4 WHEN 2 THEN event_type WHEN 3 THEN '[' || user_id || ']' END AS rest FROM events",
    "flatten_structs": "SELECT c_custkey, c_name AS who_c_name, c_nationkey AS who_place_c_nationkey, c_acctbal AS who_place_c_acctbal FROM customer",
    "explode_rows": "SELECT conv_id, turn, CASE WHEN role = 'user' THEN text END AS asked FROM conversations",
    "stamp_load_time": "SELECT TIMESTAMP '2024-02-01 00:00:00' AS bronze_updated_at, count(*) AS n FROM events",
    "pack_batches": "WITH RECURSIVE c AS (SELECT date_trunc('month', o_orderdate)::DATE AS ts, count(*) AS n FROM orders GROUP BY 1), d AS (SELECT ts, n, row_number() OVER (ORDER BY ts) AS i FROM c), r AS (SELECT i, ts, n, n AS held, 1 AS b FROM d WHERE i = 1 UNION ALL SELECT d.i, d.ts, d.n, CASE WHEN held + d.n <= 300 THEN held + d.n ELSE d.n END, CASE WHEN held + d.n <= 300 THEN b ELSE b + 1 END FROM r JOIN d ON d.i = r.i + 1) SELECT min(ts) AS lo, max(ts) AS hi, sum(n)::BIGINT AS rows FROM r GROUP BY b",
    "jdbc_scan": "SELECT event_id, date_trunc('day', ts)::TIMESTAMP AS day, event_type FROM events WHERE value > 50",
    "upsert_keyed": "WITH e AS (SELECT user_id, event_id, event_type, ts, NULL::BOOLEAN AS late FROM events WHERE ts < '2024-01-20' UNION ALL SELECT user_id, event_id, event_type, ts, true FROM events WHERE ts >= '2024-01-20' AND user_id % 7 = 0) SELECT * FROM e " + _LATEST,
    "skip_kept": "WITH e AS (SELECT day(ts) AS day, md5(event_type || '|' || props) AS payload_hash FROM events), f AS (SELECT payload_hash, min(day) AS first FROM e GROUP BY 1) SELECT payload_hash, 1::BIGINT AS held, CASE WHEN first < 10 THEN NULL WHEN first < 12 THEN 0 WHEN first <= 20 THEN 1 ELSE 2 END::INTEGER AS batch FROM f",
    "load_all_sources": "SELECT r_name AS source_table, lower(r_name) AS target_table, CASE r_regionkey WHEN 2 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN r_regionkey <> 2 THEN count(c_custkey) END AS rows, CASE r_regionkey WHEN 2 THEN 'no such source' END AS error FROM region LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey WHERE r_regionkey < 4 GROUP BY r_name, r_regionkey",
    "key_profile": "SELECT 'event_id' AS key, count(*) AS n FROM events UNION ALL SELECT 'large', count(*) FROM events WHERE value > 50 HAVING count(*) > 0 UNION ALL SELECT 'clicked', count(*) FROM events WHERE event_type = 'click' HAVING count(*) > 0",
    "shape_profile": "SELECT CASE event_type WHEN 'click' THEN 'object' WHEN 'view' THEN 'array' WHEN 'error' THEN 'unparsed' ELSE 'scalar' END AS shape, count(*) AS n FROM events GROUP BY 1",
    "mapping_keys": "SELECT 'o_orderkey' AS key FROM orders HAVING count(*) = count(DISTINCT o_orderkey) UNION ALL SELECT 'o_custkey' FROM orders HAVING count(*) = count(DISTINCT o_custkey) UNION ALL SELECT 'o_code' FROM orders HAVING count(*) = count(DISTINCT 'o' || o_orderkey)",
    "open_versions": "WITH l AS (SELECT user_id, ts::DATE AS starts, CASE WHEN day(ts) % 4 <> 0 THEN ts::DATE + 1 END AS ends FROM events) SELECT 'not null: starts' AS rule, count(*) FILTER (starts IS NULL) AS violations FROM l UNION ALL SELECT 'check: order', 0 UNION ALL SELECT 'unique: user_id, starts', coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM l GROUP BY user_id, starts HAVING count(*) > 1) UNION ALL SELECT 'one open version: user_id', coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM l WHERE ends IS NULL GROUP BY user_id HAVING count(*) > 1)",
}
QUERIES = {
    f.__name__: f
    for f in (
        json_ladder, unwrap_envelope, needs_repair, problem_key_profile, structure_profile, breaker_profile, process_table_repaired, parse_quarantine, replay_quarantine, rebuild_parent, rebuild_child, run_tables, full_replace, table_sink,
        collect_identities, spine_coverage, staff_classify, discovered_fields, nested_drift, descend_degraded, flatten_structs, explode_rows, stamp_load_time, pack_batches, jdbc_scan, upsert_keyed, skip_kept, load_all_sources, key_profile, shape_profile, mapping_keys, open_versions,
    )
}
