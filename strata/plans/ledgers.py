"""Queries on upserts, ledgers, identity and scores over the given tables, with their SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.shared import stage
from strata.operators import dedup, history, identity, joins, metrics, quality, scoring, upsert
from strata.plans import parents
from strata.plans.tables import read

AS_OF = "2024-01-31"


def _versions(spark, d) -> DataFrame:
    """Events as versions of users, with the load columns of a parent."""
    return read(spark, d, "events").select("user_id", "event_id", "event_type", "value", "ts", F.col("ts").alias("bronze_updated_at"), F.col("ts").alias("bronze_insert_date"))


def upsert_by_key(spark, d):
    v = _versions(spark, d)
    target = dedup.latest_per_key(v.where("ts < '2024-01-20'").drop("value"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    one = dedup.latest_per_key(v.where("ts >= '2024-01-15'").drop("event_type"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return upsert.upsert_by_key(target, one, "user_id", event_time="ts").select("user_id", "event_id", "event_type", "value", "ts", "bronze_insert_date")


def window_replace(spark, d):
    v = read(spark, d, "events").select("event_id", "ts", "value")
    batch = v.where("ts > '2024-01-10'").withColumn("value", F.round(F.col("value") * 2, 4))
    return upsert.window_replace(v, batch, "ts", datetime(2024, 1, 20))


def replace_affected_keys(spark, d):
    lines = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    changed = read(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    fresh = lines.join(changed, "l_orderkey", "left_semi").withColumn("l_quantity", F.col("l_quantity") + 1)
    return upsert.replace_affected_keys(lines, fresh, "l_orderkey", changed)


def write_route(spark, d):
    v = read(spark, d, "events").select("event_id", "ts", "value")
    return upsert.write_route(v, v.where("ts > '2024-01-25'"), watermark=datetime(2024, 1, 20), ts_col="ts")[1]


def contract_checks(spark, d):
    orders = read(spark, d, "orders")
    return upsert.contract_checks(orders, not_null=["o_orderkey", "o_custkey"], unique=[["o_orderkey"], ["o_custkey"]], checks={"price": F.col("o_totalprice") > 1000, "status": F.col("o_orderstatus").isin("F", "O")})


def null_key_quarantine(spark, d):
    orders = read(spark, d, "orders").select(F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("k"), "o_custkey")
    empty = spark.createDataFrame([], "table_name string, pk_column string, payload_hash string, row_json string")
    _, add = upsert.null_key_quarantine(orders, empty, "k", table="orders")
    return add.select("table_name", "pk_column", F.get_json_object("row_json", "$.o_custkey").cast("bigint").alias("o_custkey"))


def _state(spark, d, until):
    e = read(spark, d, "events").where(F.col("ts") < F.lit(until).cast("timestamp"))
    e = dedup.latest_per_key(e, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return e.select("user_id", "event_type", F.datediff(F.lit(until).cast("date"), F.col("ts")).alias("days"))


def _ledger(spark, d):
    source = _state(spark, d, "2024-01-10").where("event_type <> 'signup'")
    first = source.withColumn("HASH_VALUE", history.scd2_hash(["user_id", "event_type"])).withColumns({history.START: F.lit("2024-01-10").cast("date"), history.END: F.lit(None).cast("date")})
    return history.scd2_apply(first, _state(spark, d, "2024-01-20").where("event_type <> 'view'"), "user_id", ["user_id", "event_type"], ["days"], as_of="2024-01-20")


def scd2_apply(spark, d):
    return _ledger(spark, d).drop("HASH_VALUE").withColumnsRenamed({history.START: "starts", history.END: "ends"})


def scd2_change_log(spark, d):
    return history.scd2_change_log(_ledger(spark, d), "user_id", "2024-01-20", ["event_type"]).withColumn("changed", F.array_join("changed", ","))


def daily_snapshot(spark, d):
    ledger = _ledger(spark, d).drop("HASH_VALUE")
    old = history.daily_snapshot(None, ledger, as_of="2024-01-20").unionByName(history.daily_snapshot(None, ledger, as_of="2024-01-05"))
    return history.daily_snapshot(old, ledger, as_of="2024-01-20", keep_days=10)


def _merges(spark, d):
    from pyspark.sql import Window

    before = F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    return read(spark, d, "orders").select("o_orderkey", before.alias("winner"))


def merge_map(spark, d):
    return history.merge_map(_merges(spark, d), "o_orderkey", "winner")


def merge_fold_report(spark, d):
    return history.merge_fold_report(read(spark, d, "orders").select("o_orderkey"), merge_map(spark, d), "o_orderkey")


def _links(spark, d):
    c = read(spark, d, "customer")
    links = F.array(F.concat_ws("|", "c_nationkey", "c_mktsegment", F.floor(F.col("c_acctbal") / 2000)), F.concat_ws("/", "c_nationkey", F.floor(F.col("c_acctbal") / 100)))
    return c.select(F.col("c_custkey").alias("hash"), F.explode(links).alias("email"), F.col("c_nationkey").alias("lead_id"), F.lit(None).cast("string").alias("contact_id"), F.lit("customer").alias("source"))


def identity_one_hop(spark, d):
    return identity.identity_groups(_links(spark, d), hops=1)


def identity_closure(spark, d):
    return identity.identity_groups(_links(spark, d))


def identity_daily(spark, d):
    """The closure of half the customers' links, then two batches of the other half: groups that a batch touches are closed anew."""
    e, part = _links(spark, d), F.pmod("hash", F.lit(4))
    done = e.where(part < 2)
    groups = stage(identity.identity_groups(done), "groups")
    for k in (2, 3):
        groups = stage(identity.update_groups(groups, done, e.where(part == k)), "groups")
        done = e.where(part <= k)
    return groups


def identity_spine(spark, d):
    e = _links(spark, d)
    return identity.identity_spine(e, identity.identity_groups(e)).select("group_key", "hashes", "real_emails", "lead_ids")


def identities_by_email(spark, d):
    return identity.identities_by_email(_links(spark, d)).select("email", "hashs", "n_hashs")


def dense_id(spark, d):
    return identity.dense_id(read(spark, d, "customer").select("c_custkey", "c_name"), "c_name")


def owner_blocklist(spark, d):
    links = read(spark, d, "customer").select("c_nationkey", F.substring("c_name", 10, 20).alias("v"), (F.col("c_acctbal") > 0).alias("own"), (F.col("c_mktsegment") == "BUILDING").alias("real"))
    blocked = read(spark, d, "supplier").select(F.substring("s_name", 10, 20).alias("v"))
    return identity.owner_blocklist(links, blocked, owner="c_nationkey", value="v", own="own", real="real").select("c_nationkey", F.size("values").alias("n"), "primary")


def extract_names(spark, d):
    docs = read(spark, d, "documents").select("source", "text")
    return identity.extract_names(docs, "source", [(F.col("text"), r"\n(The [a-z]{2,4}) ", False), (F.col("text"), r"^The\s+([A-Za-z]+)", True)])


def role_attribution(spark, d):
    """Lines of orders go to the order's customer; urgent orders have a second owner here, so they are nobody's."""
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    bridge = o.drop("o_orderpriority").unionByName(o.where("o_orderpriority = '1-URGENT'").select("l_orderkey", (F.col("o_custkey") + 1).alias("o_custkey")))
    return identity.role_attribution(read(spark, d, "lineitem"), bridge, value="l_orderkey", owner="o_custkey", roles={"lines": F.lit(True), "returned": F.col("l_returnflag") == "R"})


def missed_calls(spark, d):
    e = read(spark, d, "events")
    return metrics.missed_calls(e, "user_id", "event_id", "ts", as_of=AS_OF, where=F.col("event_type") == "error", spine=e)


def days_until_next(spark, d):
    return metrics.days_until_next(read(spark, d, "events"), "user_id", "ts", as_of="2024-01-25")


def share_of_total(spark, d):
    return metrics.share_of_total(read(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"], within=["o_orderstatus"])


def concentration(spark, d):
    orders = read(spark, d, "orders").withColumn("failed", (F.col("o_orderstatus") == "F").cast("int"))
    return metrics.concentration(orders, "o_orderpriority", "failed")


def booking_recency(spark, d):
    e = read(spark, d, "events").select("event_id", F.concat(F.lit(" U"), "user_id", F.lit("@X.org")).alias("mail"), "ts", F.col("ts").alias("updated"))
    return metrics.booking_recency(e, "mail", "event_id", "ts", "updated", as_of=AS_OF)


def sentiment(spark, d):
    labels = read(spark, d, "customer").select("c_custkey", F.when(F.col("c_nationkey") < 5, " none").otherwise(F.lower("c_mktsegment")).alias("label"))
    return metrics.sentiment(read(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), labels, "c_custkey", "label")


# what an event stands for as an activity: type, status, direction, disposition
_ACT = {"click": ("Email", "inbox", "incoming", None), "view": ("Email", "sent", "outgoing", None), "purchase": ("Call", None, "outbound", "answered"), "error": ("Call", None, "inbound", "no-answer"), "signup": ("SMS", None, "outbound", None)}


def _acts(spark, d):
    m = lambda i: F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v[i])) for k, v in _ACT.items()])
    return read(spark, d, "events").select(F.col("user_id").alias("lead_id"), F.col("ts").alias("activity_at"), m(0).alias("type"), m(1).alias("status"), m(2).alias("direction"), m(3).alias("disposition"))


def _signals(spark, d):
    e = read(spark, d, "events").where("value > 90")
    return scoring.last_days(e, "user_id", "ts", {"in_days": F.col("event_type") == "click", "out_days": F.col("event_type") == "view"}, as_of=AS_OF).withColumnRenamed("user_id", "lead_id")


def engagement_score(spark, d):
    e = read(spark, d, "events")
    days = scoring.last_days(e, "user_id", "ts", {"days_message": (F.col("event_type") == "click") & (F.col("value") > 50), "days_login": (F.col("event_type") == "view") & (F.col("value") > 60), "days_meeting": F.col("event_type") == "purchase", "days_booking": (F.col("event_type") == "signup") & (F.col("value") > 30)}, as_of=AS_OF)
    more = e.groupBy("user_id").agg(F.count_if((F.col("event_type") == "error") & (F.col("ts") >= "2024-01-25")).alias("missed"), F.when(F.max("value") > 200, "positive").when(F.max("value") > 100, "neutral").otherwise("negative").alias("sentiment"))
    return scoring.engagement_score(days.join(more, "user_id")).select("user_id", "message_flag", "platform_flag", "meeting_flag", "engagement_pattern", "base_score", "final_score", "health_band")


def communication_state(spark, d):
    return scoring.communication_state(_acts(spark, d), _signals(spark, d), as_of=AS_OF).select("lead_id", "client_reach_days", "we_connected_days", "we_attempted_days", "whose_turn", "all_out_attempted")


def waiting_backlog(spark, d):
    state = scoring.communication_state(_acts(spark, d), _signals(spark, d), as_of=AS_OF)
    return scoring.waiting_backlog(state, read(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("lead_id")))


def _recency(spark, d):
    return scoring.communication_recency(_acts(spark, d), _signals(spark, d), read(spark, d, "customer").select(F.col("c_custkey").alias("lead_id")), as_of=AS_OF)


def communication_recency(spark, d):
    return _recency(spark, d).select("lead_id", "last_contact_in_days", "last_contact_out_days", "last_attempt_days", "channels_out_14d", "whose_turn", "exhausted_outreach_flag")


def turn_age_report(spark, d):
    return scoring.turn_age_report(_recency(spark, d), F.least("last_contact_in_days", "last_contact_out_days"))


def _scored(spark, d):
    facts = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("lead_id")).agg(F.round(F.sum("o_totalprice"), 2).alias("contract_value"), F.min(F.to_date("o_orderdate")).alias("sale_date"))
    one = joins.enrich_left(_recency(spark, d), facts, "lead_id")
    owners = read(spark, d, "customer").select(F.col("c_custkey").alias("lead_id"), F.col("c_mktsegment").alias("csm_name"), F.lit("GOOD").alias("health_band"), F.lit(80).alias("final_score"))
    one = joins.enrich_left(one, owners, "lead_id").withColumns({"days_since_meeting": F.col("call_out_contact_days"), "days_until_meeting": F.lit(None).cast("int")})
    return scoring.service_score(one, as_of=AS_OF)


def service_score(spark, d):
    return _scored(spark, d).select("lead_id", "paying_client", "reply_owed", "reply_days_past_promise", "no_attempt_since_reach", "promise_overdue_30d", "contract_without_delivery", "company_minimal_service", "company_service_score", "service_verdict")


def _rollup(name):
    def run(spark, d):
        got = scoring.service_rollups(_scored(spark, d))[name]
        return got.select("lead_id", "owner", "service_verdict", "company_service_score") if name == "worst" else got

    return run


def type_conflicts(spark, d):
    events = read(spark, d, "events").select("props", F.from_json("props", "k date, missing string").alias("parsed"))
    return quality.type_conflicts(events, "props", "parsed")


def null_hygiene(spark, d):
    return quality.null_hygiene(read(spark, d, "documents"))


def key_format_drift(spark, d):
    orders = read(spark, d, "orders").select("o_orderdate", F.when(F.month("o_orderdate") == 3, F.concat(F.lit("x"), "o_orderkey")).otherwise(F.col("o_orderkey").cast("string")).alias("k"))
    return quality.key_format_drift(orders, "k", "o_orderdate")


def event_time_regressions(spark, d):
    return quality.event_time_regressions(read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", "o_orderkey", "o_orderdate")


def event_time_format(spark, d):
    t = F.when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return quality.event_time_format(read(spark, d, "events").select(t.alias("t")), "t")


def epoch_unit_drift(spark, d):
    return quality.epoch_unit_drift(read(spark, d, "orders"), 1996)


def deletion_drift(spark, d):
    e = read(spark, d, "events").select(F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("id"), F.to_date("ts").alias("day"))
    return quality.deletion_drift(e, "id", "day", 3)


def dynamic_key_maps(spark, d):
    e = read(spark, d, "events").select(F.to_json(F.map_from_arrays(F.array(F.concat(F.lit("u"), "user_id"), F.col("event_type")), F.array("value", "value"))).alias("j"))
    return quality.dynamic_key_maps(e, "j", 0.05)


def literal_leaks(spark, d):
    docs = read(spark, d, "documents").select(F.when(F.col("lang") == "en", "None").otherwise(F.col("lang")).alias("lang"), "source")
    return quality.literal_leaks(docs)


def _run_log(spark, d):
    days = read(spark, d, "events").groupBy(F.to_date("ts").alias("day"), F.col("event_type").alias("silver_name")).agg(F.count("*").alias("n"), F.count_if(F.col("value") > 5).alias("ok"), F.countDistinct("user_id").cast("int").alias("f"))
    return days.select(F.col("day").cast("string").alias("run_id"), F.col("day").cast("timestamp").alias("logged_at"), "silver_name", F.lit("cdc").alias("mode"), F.when(F.col("silver_name") == "signup", 0).otherwise(F.col("n")).cast("bigint").alias("cdc_rows"), F.col("f").alias("fields_discovered"), F.col("ok").alias("parsed_valid"), (F.col("n") - F.col("ok")).alias("parsed_null"), F.lit(None).cast("string").alias("note"), F.to_json(F.create_map(F.lit("1"), F.col("ok"), F.lit("3"), F.col("n") - F.col("ok"))).alias("rung_stats"))


def fleet_health(spark, d):
    log = _run_log(spark, d)
    quarantine = read(spark, d, "events").select(F.col("event_type").alias("silver_name"), F.col("ts").alias("quarantined_at"))
    expected = log.select("silver_name").distinct().unionByName(read(spark, d, "region").select(F.col("r_name").alias("silver_name")))
    return quality.fleet_health(log, quarantine, expected, as_of="2024-01-30", limits={"parse_rate": 1.1, "fields": 10, "quarantine_day": 1})


def process_table(spark, d):
    raw = read(spark, d, "events").select(F.to_json(F.struct(F.col("user_id").alias("id"), "event_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date_updated"), F.from_json("props", "k bigint").alias("props"))).alias("raw_data"), F.col("ts").alias("insert_date"), F.col("ts").alias("bronze_updated_at"))
    out = parents.process_table(raw, None, parents.Config("bronze_events", "events", key="id"))
    return out.table.select("id", "event_id", "event_type", F.col("props.k").alias("k"))


_WORLD = f"""
a AS (SELECT user_id AS lead_id, ts::DATE AS day, {", ".join(f"CASE event_type {' '.join(f'''WHEN '{k}' THEN {'NULL' if v[i] is None else repr(v[i])}''' for k, v in _ACT.items())} END AS {n}" for i, n in enumerate(("type", "status", "direction", "disposition")))} FROM events),
s AS (SELECT user_id AS lead_id, date_diff('day', max(ts::DATE) FILTER (event_type = 'click'), DATE '{AS_OF}') AS in_days, date_diff('day', max(ts::DATE) FILTER (event_type = 'view'), DATE '{AS_OF}') AS out_days FROM events WHERE value > 90 GROUP BY 1)"""


def _ago(cond: str) -> str:
    return f"date_diff('day', max(day) FILTER ({cond}), DATE '{AS_OF}')"


_STATE_SQL = f"""WITH {_WORLD},
x AS (SELECT lead_id, {_ago("type = 'Email' AND status = 'inbox'")} AS ie, {_ago("type = 'Email' AND status = 'sent'")} AS oe, {_ago("type = 'Call' AND direction = 'inbound'")} AS ic, {_ago("type = 'Call' AND direction = 'outbound'")} AS oc,
 {_ago("type = 'Call' AND disposition = 'answered'")} AS cc, {_ago("type = 'SMS' AND direction = 'outbound'")} AS os FROM a GROUP BY 1),
y AS (SELECT coalesce(x.lead_id, s.lead_id) AS lead_id, oc, oe, os, least(ie, ic, in_days) AS r, least(oe, os, cc, out_days) AS c, least(oe, os, oc, out_days) AS t FROM x FULL JOIN (SELECT * FROM s WHERE in_days IS NOT NULL OR out_days IS NOT NULL) s ON x.lead_id = s.lead_id)"""
_STATE_OUT = """lead_id, r::INT AS client_reach_days, c::INT AS we_connected_days, t::INT AS we_attempted_days,
 CASE WHEN r IS NULL AND c IS NULL THEN NULL WHEN c IS NULL OR r < c THEN 'US' WHEN r IS NULL OR c < r THEN 'CLIENT' ELSE 'CURRENT' END AS whose_turn,
 coalesce(oc <= 14, false) AND coalesce(oe <= 14, false) AND coalesce(os <= 14, false) AND (r IS NULL OR r > 14) AS all_out_attempted"""
_RECENCY_SQL = f"""WITH {_WORLD},
x AS (SELECT lead_id, {_ago("type = 'Email' AND status = 'inbox'")} AS ie, {_ago("type = 'Email' AND status = 'sent'")} AS oe, {_ago("type = 'Call' AND direction = 'inbound' AND disposition = 'no-answer'")} AS iu,
 {_ago("type = 'Call' AND direction = 'outbound' AND disposition = 'answered'")} AS oc, {_ago("type = 'SMS'")} AS os, {_ago("true")} AS anyd FROM a GROUP BY 1),
y AS (SELECT c_custkey AS lead_id, oc, least(ie, iu, in_days) AS i, least(oe, oc, os, out_days) AS o, coalesce((oe <= 14)::INT, 0) + coalesce((oc <= 14)::INT, 0) + coalesce((os <= 14)::INT, 0) + coalesce((out_days <= 14)::INT, 0) AS n, anyd, in_days, out_days
 FROM customer LEFT JOIN x ON x.lead_id = c_custkey LEFT JOIN s ON s.lead_id = c_custkey),
z AS (SELECT *, CASE WHEN i IS NULL AND o IS NULL THEN CASE WHEN coalesce(anyd, in_days, out_days) IS NULL THEN 'NO CONTACT' ELSE 'NEVER REACHED' END WHEN i = o THEN 'MUTUAL' WHEN o IS NULL OR i < o THEN 'OUR TURN' ELSE 'THEIR TURN' END AS whose_turn FROM y)"""
_SERVICE_SQL = _RECENCY_SQL + f""",
w AS (SELECT z.lead_id, whose_turn = 'OUR TURN' AS owed, CASE WHEN whose_turn = 'OUR TURN' THEN i END AS wait, coalesce(v > 0, false) AS paying, o, oc, v, c_mktsegment AS owner FROM z LEFT JOIN (SELECT o_custkey, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1) f ON f.o_custkey = z.lead_id JOIN customer ON c_custkey = z.lead_id),
q AS (SELECT *, CASE WHEN wait > 2 THEN wait - 2 END AS past, owed::INT AS untried, coalesce(wait > 30, false)::INT AS over, (paying AND oc IS NULL)::INT AS nod, (o IS NULL OR o > 30)::INT AS quiet FROM w),
g AS (SELECT *, greatest(0, 100 - least(40, 10 * coalesce(past, 0)) - 20 * untried - 40 * over - 30 * nod - 10 * quiet)::INT AS score,
 CASE WHEN NOT owed THEN 'PROMISE KEPT' WHEN wait <= 2 THEN 'WITHIN THE PROMISE (0-2 days)' WHEN wait <= 7 THEN 'PROMISE SLIPPING (3-7 days)' WHEN wait <= 30 THEN 'PROMISE BROKEN (8-30 days)' ELSE 'PROMISE ABANDONED (31+ days)' END AS verdict FROM q)"""
_LEDGER_SQL = """WITH a AS (SELECT user_id, event_type, date_diff('day', ts::DATE, DATE '2024-01-10')::INT AS days FROM events WHERE ts < '2024-01-10' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
b AS (SELECT user_id, event_type, date_diff('day', ts::DATE, DATE '2024-01-20')::INT AS days FROM events WHERE ts < '2024-01-20' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
t AS (SELECT * FROM a WHERE event_type <> 'signup'), s AS (SELECT * FROM b WHERE event_type <> 'view'),
v AS (SELECT t.user_id, t.event_type, CASE WHEN t.event_type = s.event_type THEN s.days ELSE t.days END AS days, DATE '2024-01-10' AS starts, CASE WHEN t.event_type IS NOT DISTINCT FROM s.event_type THEN NULL ELSE DATE '2024-01-20' END AS ends FROM t LEFT JOIN s ON t.user_id = s.user_id
 UNION ALL SELECT s.user_id, s.event_type, s.days, DATE '2024-01-20', NULL FROM s LEFT JOIN t ON t.user_id = s.user_id WHERE t.event_type IS DISTINCT FROM s.event_type)"""
_LINK_SQL = """e0 AS (SELECT c_custkey AS node, unnest([c_nationkey || '|' || c_mktsegment || '|' || floor(c_acctbal / 2000)::BIGINT, c_nationkey || '/' || floor(c_acctbal / 100)::BIGINT]) AS link FROM customer),
e AS (SELECT * FROM e0 WHERE node NOT IN (SELECT node FROM e0 GROUP BY 1 HAVING count(DISTINCT link) > 10) AND link NOT IN (SELECT link FROM e0 GROUP BY 1 HAVING count(DISTINCT node) > 5))"""
_CLOSE_SQL = f"""WITH RECURSIVE {_LINK_SQL}, p AS (SELECT DISTINCT a.node AS x, b.node AS y FROM e a JOIN e b ON a.link = b.link), r(x, y) AS (SELECT x, y FROM p UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x),
g AS (SELECT x AS node, min(y) AS group_key FROM r GROUP BY 1), h AS (SELECT c_custkey AS node, coalesce(group_key, c_custkey) AS group_key FROM customer LEFT JOIN g ON node = c_custkey)"""

ORACLE = {
    "upsert_by_key": """WITH t AS (SELECT * FROM events WHERE ts < '2024-01-20' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1), s AS (SELECT * FROM events WHERE ts >= '2024-01-15' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT coalesce(t.user_id, s.user_id) AS user_id, CASE WHEN t.ts IS NULL OR s.ts > t.ts THEN s.event_id ELSE t.event_id END AS event_id, t.event_type, CASE WHEN t.ts IS NULL OR s.ts > t.ts THEN s.value END AS value, CASE WHEN t.ts IS NULL OR s.ts > t.ts THEN s.ts ELSE t.ts END AS ts, coalesce(t.ts, s.ts) AS bronze_insert_date FROM t FULL JOIN s ON t.user_id = s.user_id""",
    "window_replace": "SELECT event_id, ts, value FROM events WHERE ts <= '2024-01-20' UNION ALL SELECT event_id, ts, round(value * 2, 4) FROM events WHERE ts > '2024-01-10'",
    "replace_affected_keys": "SELECT l_orderkey, l_linenumber, l_quantity + (l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'))::INT AS l_quantity FROM lineitem",
    "write_route": "SELECT event_id, ts, value FROM events WHERE ts <= '2024-01-20' OR ts > '2024-01-25'",
    "contract_checks": """SELECT 'not null: o_orderkey' AS rule, count(*) FILTER (o_orderkey IS NULL) AS violations FROM orders UNION ALL SELECT 'not null: o_custkey', count(*) FILTER (o_custkey IS NULL) FROM orders UNION ALL SELECT 'check: price', count(*) FILTER (o_totalprice <= 1000) FROM orders
UNION ALL SELECT 'check: status', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders UNION ALL SELECT 'unique: o_orderkey', coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING n > 1) UNION ALL SELECT 'unique: o_custkey', coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey HAVING n > 1)""",
    "null_key_quarantine": "SELECT DISTINCT 'orders' AS table_name, 'k' AS pk_column, o_custkey FROM orders WHERE o_orderstatus = 'P'",
    "scd2_apply": _LEDGER_SQL + " SELECT user_id, event_type, days, starts, ends FROM v",
    "scd2_change_log": _LEDGER_SQL + " SELECT o.user_id, o.event_type AS old_event_type, n.event_type AS new_event_type, CASE WHEN o.event_type <> n.event_type THEN 'event_type' ELSE '' END AS changed FROM v o JOIN v n ON o.user_id = n.user_id WHERE o.ends = DATE '2024-01-20' AND n.starts = DATE '2024-01-20'",
    "daily_snapshot": _LEDGER_SQL + " SELECT DATE '2024-01-20' AS run_date, user_id, event_type, days FROM v WHERE ends IS NULL",
    "merge_map": "SELECT o_orderkey AS loser, lag(o_orderkey) OVER w AS winner, first_value(o_orderkey) OVER w AS root, row_number() OVER w - 2 AS hops FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) QUALIFY winner IS NOT NULL",
    "merge_fold_report": "SELECT count(*) AS leads, count(DISTINCT o_custkey) AS persons, count(*) - count(DISTINCT o_custkey) AS folded FROM orders",
    "identity_one_hop": f"WITH {_LINK_SQL}, g AS (SELECT a.node, min(b.node) AS group_key FROM e a JOIN e b ON a.link = b.link GROUP BY 1) SELECT c_custkey AS node, coalesce(group_key, c_custkey) AS group_key FROM customer LEFT JOIN g ON node = c_custkey",
    "identity_closure": _CLOSE_SQL + " SELECT * FROM h",
    "identity_daily": _CLOSE_SQL + " SELECT * FROM h",
    "identity_spine": _CLOSE_SQL + " SELECT group_key, list_sort(list(DISTINCT h.node)) AS hashes, list_sort(list(DISTINCT e0.link)) AS real_emails, list_sort(list(DISTINCT c_nationkey)) AS lead_ids FROM h JOIN e0 ON e0.node = h.node JOIN customer ON c_custkey = h.node GROUP BY 1",
    "identities_by_email": f"WITH {_LINK_SQL} SELECT link AS email, list_sort(list(DISTINCT node)) AS hashs, count(DISTINCT node)::INT AS n_hashs FROM e0 GROUP BY 1",
    "dense_id": "SELECT c_custkey, c_name, dense_rank() OVER (ORDER BY c_name) AS dense_id FROM customer",
    "owner_blocklist": "WITH f AS (SELECT c_nationkey, substr(c_name, 10, 20) AS v, CASE WHEN c_acctbal > 0 AND c_mktsegment = 'BUILDING' THEN 0 WHEN c_mktsegment = 'BUILDING' THEN 1 WHEN c_acctbal > 0 THEN 2 ELSE 3 END AS r FROM customer WHERE substr(c_name, 10, 20) NOT IN (SELECT substr(s_name, 10, 20) FROM supplier)) SELECT c_nationkey, count(DISTINCT v)::INT AS n, min_by(v, (r, v)) AS \"primary\" FROM f GROUP BY 1",
    "extract_names": r"""WITH a AS (SELECT source, 1 AS r, trim(regexp_extract(text, '\n(The [a-z]{2,4}) ', 1)) AS n FROM documents), b AS (SELECT source, 2 AS r, regexp_extract(text, '^The\s+([A-Za-z]+)', 1) AS n FROM documents),
c AS (SELECT * FROM a WHERE n <> '' UNION ALL SELECT source, r, CASE WHEN n = lower(n) OR n = upper(n) THEN upper(n[1]) || lower(n[2:]) ELSE n END FROM b WHERE n <> '' AND lower(n) NOT IN ('there', 'everyone', 'everybody', 'friend', 'buddy', 'man', 'dude', 'brother', 'bro', 'boss', 'team', 'guys', 'folks', 'yes', 'no', 'quick', 'hi', 'hello', 'hey', 'you', 'it'))
SELECT source, array_to_string(list_sort(list(DISTINCT n)), ' / ') AS name, r AS rung FROM c GROUP BY source, r QUALIFY row_number() OVER (PARTITION BY source ORDER BY r) = 1""",
    "role_attribution": "SELECT o_custkey, count(*) AS lines, count(*) FILTER (l_returnflag = 'R') AS returned FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderpriority <> '1-URGENT' GROUP BY 1",
    "missed_calls": f"SELECT user_id, count(DISTINCT event_id) FILTER (event_type = 'error' AND date_diff('day', ts::DATE, DATE '{AS_OF}') BETWEEN 0 AND 14) AS missed FROM events GROUP BY 1",
    "days_until_next": "SELECT user_id, min(ts) AS next_at, date_diff('day', DATE '2024-01-25', min(ts)::DATE)::INT AS days FROM events WHERE ts::DATE >= '2024-01-25' GROUP BY 1",
    "share_of_total": "SELECT *, round(100.0 * n / sum(n) OVER (PARTITION BY o_orderstatus), 2) AS pct FROM (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)",
    "concentration": "WITH g AS (SELECT o_orderpriority, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS failing FROM orders GROUP BY 1), w AS (SELECT sum(total) AS t, sum(failing) AS f FROM g) SELECT o_orderpriority, total, failing, round(100.0 * failing / total, 1) AS failing_pct, round(100.0 * f / t, 1) AS overall_pct, round(100.0 * failing / f, 1) AS share_of_failures, round(100.0 * total / t, 1) AS share_of_total FROM g, w",
    "booking_recency": f"SELECT 'u' || user_id || '@x.org' AS email, max(ts::DATE) AS last_booking_date, date_diff('day', max(ts::DATE), DATE '{AS_OF}')::INT AS days FROM events GROUP BY user_id",
    "sentiment": "SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN 'NO_SENTIMENT' ELSE coalesce(c_mktsegment, 'NO_SENTIMENT') END AS sentiment FROM (SELECT DISTINCT o_custkey AS c_custkey FROM orders) LEFT JOIN customer USING (c_custkey)",
    "engagement_score": f"""WITH x AS (SELECT user_id, date_diff('day', max(ts::DATE) FILTER (event_type = 'click' AND value > 50), DATE '{AS_OF}') AS m, date_diff('day', max(ts::DATE) FILTER (event_type = 'view' AND value > 60), DATE '{AS_OF}') AS l, date_diff('day', max(ts::DATE) FILTER (event_type = 'purchase'), DATE '{AS_OF}') AS c,
 date_diff('day', max(ts::DATE) FILTER (event_type = 'signup' AND value > 30), DATE '{AS_OF}') AS b, count(*) FILTER (event_type = 'error' AND ts >= '2024-01-25') AS e, max(value) AS v FROM events GROUP BY 1),
f AS (SELECT *, (m <= 14)::INT AS mf, (l <= 14)::INT AS pf, CASE WHEN c IS NOT NULL AND b IS NOT NULL THEN (least(c, b) <= 30)::INT END AS gf FROM x),
p AS (SELECT *, coalesce(mf, 0) * 4 + coalesce(pf, 0) * 2 + coalesce(gf, 0) AS code, (mf IS NULL)::INT + (pf IS NULL)::INT + (gf IS NULL)::INT AS unknown FROM f),
n AS (SELECT *, CASE code WHEN 7 THEN 'SLACK + PLATFORM + MEETING' WHEN 6 THEN 'SLACK + PLATFORM' WHEN 3 THEN 'PLATFORM + MEETING' WHEN 5 THEN 'SLACK + MEETING' WHEN 4 THEN 'SLACK ONLY' WHEN 2 THEN 'PLATFORM ONLY' WHEN 1 THEN 'MEETING ONLY' ELSE CASE WHEN unknown <= 1 THEN 'NO ENGAGEMENT' ELSE 'NO DATA' END END AS pat FROM p),
o AS (SELECT *, CASE pat WHEN 'NO ENGAGEMENT' THEN 20 WHEN 'NO DATA' THEN NULL ELSE ([40, 50, 75, 30, 60, 80, 90])[code] END AS base FROM n),
z AS (SELECT *, base + CASE WHEN e = 0 THEN 5 WHEN e >= 3 THEN -15 ELSE 0 END + CASE WHEN v > 200 THEN 10 WHEN v > 100 THEN 5 ELSE -25 END AS fin FROM o)
SELECT user_id, mf AS message_flag, pf AS platform_flag, gf AS meeting_flag, pat AS engagement_pattern, base AS base_score, fin AS final_score, CASE WHEN fin IS NULL THEN 'NO DATA' WHEN fin >= 75 THEN 'GOOD' WHEN fin >= 50 THEN 'AVERAGE' ELSE 'POOR' END AS health_band FROM z""",
    "communication_state": _STATE_SQL + f" SELECT {_STATE_OUT} FROM y",
    "waiting_backlog": _STATE_SQL + f", z AS (SELECT {_STATE_OUT} FROM y) SELECT CASE WHEN client_reach_days <= 3 THEN '0-3 days (live queue)' WHEN client_reach_days <= 7 THEN '4-7 days' WHEN client_reach_days <= 14 THEN '8-14 days' WHEN client_reach_days <= 30 THEN '15-30 days' ELSE '> 30 days (dropped)' END AS waiting_since, we_connected_days IS NULL AS never_connected, we_attempted_days IS NULL AS never_attempted, count(*) AS leads FROM z WHERE whose_turn = 'US' AND lead_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY ALL",
    "communication_recency": _RECENCY_SQL + " SELECT lead_id, i::INT AS last_contact_in_days, o::INT AS last_contact_out_days, NULL::INT AS last_attempt_days, n AS channels_out_14d, whose_turn, (n >= 3 AND (i IS NULL OR i > 30))::INT AS exhausted_outreach_flag FROM z",
    "turn_age_report": _RECENCY_SQL + ", t AS (SELECT whose_turn, coalesce(CASE WHEN least(i, o) <= 3 THEN '0-3' WHEN least(i, o) <= 7 THEN '4-7' WHEN least(i, o) <= 14 THEN '8-14' WHEN least(i, o) <= 30 THEN '15-30' WHEN least(i, o) <= 90 THEN '31-90' WHEN least(i, o) > 90 THEN '90+' END, 'never') AS age FROM z) SELECT *, round(100.0 * n / sum(n) OVER (PARTITION BY whose_turn), 2) AS pct FROM (SELECT whose_turn, age, count(*) AS n FROM t GROUP BY ALL)",
    "service_score": _SERVICE_SQL + " SELECT lead_id, paying AS paying_client, owed AS reply_owed, past::INT AS reply_days_past_promise, untried AS no_attempt_since_reach, over AS promise_overdue_30d, nod AS contract_without_delivery, quiet AS company_minimal_service, score AS company_service_score, verdict AS service_verdict FROM g",
    "service_ladder": _SERVICE_SQL + " SELECT verdict AS service_verdict, count(*) AS clients, round(avg(score), 1) AS avg_score FROM g GROUP BY 1",
    "service_dollars": _SERVICE_SQL + " SELECT verdict AS service_verdict, count(*) AS clients, round(sum(v), 2) AS dollars FROM g WHERE paying GROUP BY 1",
    "service_by_owner": _SERVICE_SQL + " SELECT owner, count(*) AS clients, sum(coalesce(wait >= 3, false)::INT)::BIGINT AS past_promise, round(avg(score), 1) AS avg_score FROM g GROUP BY 1",
    "service_ladder_long": _SERVICE_SQL + " SELECT owner, verdict AS service_verdict, count(*) AS clients FROM g GROUP BY ALL",
    "service_ladder_wide": _SERVICE_SQL + " SELECT owner, count(*) AS clients, count(*) FILTER (verdict LIKE '%KEPT') AS kept, count(*) FILTER (verdict LIKE 'WITHIN%') AS within_promise, count(*) FILTER (verdict LIKE '%SLIPPING%') AS slipping, count(*) FILTER (verdict LIKE '%BROKEN%') AS broken, count(*) FILTER (verdict LIKE '%ABANDONED%') AS abandoned, round(avg(score), 1) AS avg_score FROM g GROUP BY 1",
    "service_beside": _SERVICE_SQL + " SELECT 'GOOD' AS health_band, verdict AS service_verdict, count(*) AS clients, 80.0::DOUBLE AS avg_health, round(avg(score), 1) AS avg_service FROM g GROUP BY 2",
    "service_concentration": _SERVICE_SQL + ", k AS (SELECT owner, count(*) AS total, sum(coalesce(wait >= 3, false)::INT)::BIGINT AS failing FROM g GROUP BY 1), l AS (SELECT sum(total) AS t, sum(failing) AS f FROM k) SELECT owner, total, failing, round(100.0 * failing / total, 1) AS failing_pct, round(100.0 * f / t, 1) AS overall_pct, round(100.0 * failing / f, 1) AS share_of_failures, round(100.0 * total / t, 1) AS share_of_total FROM k, l",
    "service_worst": _SERVICE_SQL + " SELECT lead_id, owner, verdict AS service_verdict, score AS company_service_score FROM g ORDER BY score, v DESC NULLS LAST, lead_id LIMIT 15",
    "service_bench": _SERVICE_SQL + ", k AS (SELECT owner, count(*) AS clients FROM g GROUP BY 1) SELECT count(*) AS owners, sum(clients)::BIGINT AS clients, round(avg(clients), 1) AS clients_per_owner, max(clients) AS largest_book FROM k",
    "type_conflicts": "SELECT 'k' AS field, 'lost' AS problem, count(*) AS n, 1.0::DOUBLE AS share FROM events WHERE props->>'k' IS NOT NULL",
    "null_hygiene": "WITH n AS (SELECT count(*) AS rows, " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in ("doc_id", "text", "lang", "source", "n_chars")) + ", count(*) FILTER (coalesce(doc_id::VARCHAR, text, lang, source, n_chars::VARCHAR) IS NULL) AS x FROM documents) " + " UNION ALL ".join(f"SELECT '{n}' AS \"column\", {c} AS nulls, rows, {c} = rows AS all_null FROM n" for n, c in (("doc_id", "doc_id"), ("text", "text"), ("lang", "lang"), ("source", "source"), ("n_chars", "n_chars"), ("*", "x"))),
    "key_format_drift": "WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, min(CASE WHEN month(o_orderdate) = 3 THEN 'other' ELSE 'numeric' END) AS classes FROM orders GROUP BY 1) SELECT month, classes, false AS mixed, coalesce(lag(classes) OVER (ORDER BY month) <> classes, false) AS flipped FROM m",
    "event_time_regressions": "SELECT * FROM (SELECT o_custkey, o_orderkey, o_orderdate, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders) WHERE o_orderdate < before",
    "event_time_format": "SELECT CASE WHEN event_type = 'view' THEN 'date' ELSE 'spaced' END AS format, CASE WHEN event_type = 'view' THEN 10 ELSE 19 END AS length, count(*) AS n FROM events GROUP BY ALL",
    "epoch_unit_drift": "SELECT 'o_orderdate' AS \"column\", count(*) FILTER (year(o_orderdate) < 1996) AS n FROM orders",
    "deletion_drift": "SELECT user_id || '-' || event_type AS id, max(ts::DATE) AS last_seen FROM events GROUP BY 1 HAVING max(ts::DATE) < (SELECT min(x) FROM (SELECT DISTINCT ts::DATE AS x FROM events ORDER BY x DESC LIMIT 3))",
    "fleet_health": "WITH a AS (SELECT event_type AS s, ts::DATE AS d, count(*) AS n, count(*) FILTER (value > 5) AS ok, count(DISTINCT user_id) AS f FROM events GROUP BY ALL), l AS (SELECT *, CASE WHEN s = 'signup' THEN 0 ELSE n END AS cdc, lag(f) OVER (PARTITION BY s ORDER BY d) AS before FROM a WHERE d <= '2024-01-30'), t AS (SELECT * FROM l WHERE d = '2024-01-30'), "
    "m AS (SELECT s, d = '2024-01-30' AS now, unnest(['1', '3']) AS rung, unnest([ok, n - ok]) AS k FROM l WHERE d >= '2024-01-23'), p AS (SELECT s, now, rung, 100.0 * sum(k) / sum(sum(k)) OVER (PARTITION BY s, now) AS pct FROM m GROUP BY s, now, rung), "
    "c AS (SELECT DISTINCT s FROM a UNION SELECT r_name FROM region) "
    "SELECT s AS silver_name, 'missing run' AS \"check\", 'no run today' AS detail FROM c WHERE s NOT IN (SELECT s FROM t) "
    "UNION ALL SELECT s, 'empty streak', count(*)::VARCHAR FROM l JOIN (SELECT s, max(d) FILTER (cdc > 0) AS m FROM l GROUP BY s) USING (s) WHERE m IS NULL OR d > m GROUP BY s HAVING count(*) >= 3 "
    "UNION ALL SELECT s, 'stale', (24.0 * ('2024-01-30'::DATE - max(d)))::DECIMAL(9, 1)::VARCHAR FROM l GROUP BY s HAVING max(d) < '2024-01-28' "
    "UNION ALL SELECT s, 'parse rate', round(ok / n, 3)::VARCHAR FROM t WHERE ok / n < 1.1 "
    "UNION ALL SELECT s, 'field jump', before || ' to ' || f FROM t WHERE abs(f - before) > 10 "
    "UNION ALL SELECT s, 'quarantine flood', n::VARCHAR FROM t WHERE n > 1 "
    "UNION ALL SELECT x.s, 'rung shift', x.rung || ': ' || round(abs(x.pct - y.pct), 1) FROM p x JOIN p y ON x.s = y.s AND x.rung = y.rung WHERE x.now AND NOT y.now AND round(abs(x.pct - y.pct), 1) > 25 "
    "UNION ALL SELECT s, 'field budget', max(f)::VARCHAR FROM l GROUP BY s HAVING max(f) > 10",
    "dynamic_key_maps": "WITH k AS (SELECT 'u' || user_id AS key FROM events UNION ALL SELECT event_type FROM events), n AS (SELECT key, count(*) AS n FROM k GROUP BY 1) SELECT key, n, round(n / (SELECT count(*) FROM events), 6) AS share FROM n WHERE round(n / (SELECT count(*) FROM events), 6) <= 0.05",
    "literal_leaks": "SELECT 'lang' AS \"column\", count(*) AS n FROM documents WHERE lang = 'en'",
    "process_table": "SELECT user_id AS id, event_id, event_type, (props->>'k')::BIGINT AS k FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
}
_ALL = (
    upsert_by_key, window_replace, replace_affected_keys, write_route, contract_checks, null_key_quarantine, scd2_apply, scd2_change_log, daily_snapshot, merge_map, merge_fold_report, identity_one_hop, identity_closure, identity_daily, identity_spine, identities_by_email, dense_id,
    owner_blocklist, extract_names, role_attribution, missed_calls, days_until_next, share_of_total, concentration, booking_recency, sentiment, engagement_score, communication_state, waiting_backlog, communication_recency, turn_age_report, service_score,
    type_conflicts, null_hygiene, key_format_drift, event_time_regressions, event_time_format, epoch_unit_drift, deletion_drift, dynamic_key_maps, literal_leaks, fleet_health, process_table,
)
QUERIES = {f.__name__: f for f in _ALL} | {f"service_{n}": _rollup(n) for n in ("ladder", "dollars", "beside", "worst", "by_owner", "concentration", "ladder_wide", "ladder_long", "bench")}
