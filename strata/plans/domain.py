"""Queries on dimensions, facts and plain aggregates over the given tables, with their SQL.

customer stands for leads, orders for sales, supplier for staff, events for activities.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import aggregates, facts, metrics, reshape
from strata.plans.tables import read


def _users(spark, d):
    s = read(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.concat(F.lit(" "), "s_name", F.lit("@CORP.com")).alias("email"), F.col("s_name").alias("first_name"), F.lit(None).cast("string").alias("last_name"), F.col("s_acctbal").alias("date_updated"))
    return s.unionByName(s.withColumns({"date_updated": F.col("date_updated") - 1, "first_name": F.lit("old")}))


def staff_dim(spark, d):
    return facts.staff_dim(_users(spark, d))


def activity_fact(spark, d):
    acts = read(spark, d, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("lead_id"), F.col("user_id").cast("string").alias("created_by"), F.col("ts").alias("activity_at"))
    return facts.activity_fact(acts, staff_dim(spark, d)).select("id", "lead_id", "staff_name")


def _leads(spark, d):
    return read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_nationkey") > 20, "").otherwise(F.col("c_name")).alias("name"), F.col("c_mktsegment").alias("status_label"), F.col("c_acctbal").alias("date_updated"))


def lead_dim(spark, d):
    names = read(spark, d, "customer").select(F.col("c_custkey").alias("lead_id"), F.col("c_mktsegment").alias("name"))
    merges = read(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("loser"), F.col("c_nationkey").cast("bigint").alias("root"))
    return facts.lead_dim(_leads(spark, d), names=names, merges=merges).select("lead_id", "name", "status_label", "merged_into")


def sales_fact(spark, d):
    acts = read(spark, d, "orders").select(F.col("o_custkey").alias("lead_id"), F.col("o_orderpriority").alias("custom_activity_type_id"), F.col("o_orderdate").alias("activity_at"), F.col("o_orderkey").alias("date_updated"), F.create_map(F.lit("cf_price"), F.col("o_totalprice").cast("string"), F.lit("status"), "o_orderstatus").alias("custom_fields"))
    types = read(spark, d, "orders").select(F.col("o_orderpriority").alias("id"), F.substring("o_orderpriority", 3, 20).alias("name")).distinct()
    fields = spark.createDataFrame([("price", "Price"), ("status", " State ")], "id string, name string")
    out = facts.sales_fact(acts, types, fields, sale_types=["urgent", "HIGH"], values={"price": "price", "state": "State"})
    return out.withColumn("price", F.col("price").cast("double"))


def sales_gap_report(spark, d):
    leads = read(spark, d, "customer").select(F.col("c_custkey").alias("lead_id"), F.col("c_acctbal").alias("contract_value"))
    merges = leads.where("lead_id % 7 = 0").select(F.col("lead_id").alias("loser"))
    return facts.sales_gap_report(leads, sales_fact(spark, d), merges=merges, clients=read(spark, d, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("lead_id")))


def health_metrics(spark, d):
    spend = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("lead_id")).agg(F.round(F.sum("o_totalprice"), 2).alias("spend"))
    return facts.health_metrics(_leads(spark, d).withColumnRenamed("id", "lead_id"), {"spend": spend}, client_status=["building", "MACHINERY"], intern_pattern="^AUTO").select("lead_id", "spend", "is_intern", "is_unlinked")


def days_since_login(spark, d):
    users = read(spark, d, "events").select(F.col("user_id").alias("uid"), F.concat(F.lit("u"), "user_id").alias("mail"), F.when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd")).when(F.col("event_type") == "click", "1970-01-01").otherwise("").alias("access"))
    leads = read(spark, d, "customer").select("c_custkey", F.concat(F.lit("u"), "c_custkey").alias("cmail"))
    return metrics.days_since_login(leads, users, [("c_custkey", "uid"), ("cmail", "mail")], key="c_custkey", access="access", as_of="2024-01-31")


def group_counts(spark, d):
    return aggregates.group_counts(read(spark, d, "orders"), ["o_orderstatus"], "o_totalprice")


def conditional_agg(spark, d):
    return aggregates.conditional_agg(read(spark, d, "events"), ["user_id"], {t: (F.col("event_type") == t, F.col("ts")) for t in ("click", "view")})


def collect_set_sorted(spark, d):
    return aggregates.collect_set_sorted(read(spark, d, "customer"), ["c_nationkey"], "c_mktsegment", joined_by=" / ")


def having_filter(spark, d):
    return aggregates.having_filter(read(spark, d, "orders"), ["o_custkey"], least=5, most=12)


def rank_window(spark, d):
    return aggregates.rank_window(read(spark, d, "orders"), ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], most=3).select("o_custkey", "o_orderkey", "rank")


def rank_then_filter(spark, d):
    return aggregates.rank_then_filter(read(spark, d, "orders"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], F.col("o_orderstatus") == "F").select("o_custkey", "o_orderkey")


def top_n(spark, d):
    return aggregates.top_n(read(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 20)


def seeded_sample(spark, d):
    return aggregates.seeded_sample(read(spark, d, "orders").select("o_orderkey"), "o_orderkey", 0.1)


def union_distinct(spark, d):
    c, s = read(spark, d, "customer").select(F.col("c_nationkey").alias("n")), read(spark, d, "supplier").select(F.col("s_nationkey").alias("n"))
    return aggregates.union_distinct([c, s])


def union_all(spark, d):
    c, s = read(spark, d, "customer").select(F.col("c_nationkey").alias("n"), F.lit("c").alias("kind")), read(spark, d, "supplier").select(F.col("s_nationkey").alias("n"))
    return aggregates.union_all([c, s]).groupBy("n", "kind").agg(F.count("*").alias("rows"))


def cross_scalar(spark, d):
    orders = read(spark, d, "orders")
    one = aggregates.cross_scalar(orders.groupBy("o_orderstatus").agg(F.count("*").alias("n")), orders.agg(F.count("*").alias("total")))
    return one.select("o_orderstatus", F.round(F.col("n") / F.col("total"), 6).alias("share"))


def self_join_versions(spark, d):
    return aggregates.self_join_versions(read(spark, d, "orders"), "o_custkey", "o_orderkey", ["o_orderstatus"])


def attributed_sales(spark, d):
    """Orders with the nation that alone owns their customer's code."""
    sales = read(spark, d, "orders").select("o_orderkey", F.pmod("o_custkey", F.lit(80)).alias("code"))
    bridge = read(spark, d, "supplier").select(F.pmod("s_suppkey", F.lit(80)).alias("code"), F.col("s_nationkey").alias("owner"))
    return facts.attributed_sales(sales, bridge, value="code", owner="owner").select("o_orderkey", "owner")


def days_until_next_by_spine(spark, d):
    """Groups of four customers each, reached by their ids, and those of odd ids by mail as well."""
    c = read(spark, d, "customer").select("c_custkey", F.floor(F.col("c_custkey") / 4).alias("group_key"))
    mail = F.when(F.pmod("c_custkey", F.lit(2)) == 1, F.concat(F.lit("u"), "c_custkey"))
    spine = c.groupBy("group_key").agg(F.sort_array(F.collect_list("c_custkey")).alias("lead_ids"), F.sort_array(F.collect_list(mail)).alias("mails"))
    e = read(spark, d, "events").select("user_id", F.concat(F.lit("u"), F.col("user_id") + 1).alias("mail"), "ts")
    return facts.days_until_next_by_spine(e, spine, [("user_id", "leads"), ("mail", "mails")], ts_col="ts", as_of="2024-01-15")


def derived_columns(spark, d):
    c = read(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", F.when(F.col("c_nationkey") < 5, " ").when(F.col("c_nationkey") < 20, F.lit("n")).alias("mark"), "c_acctbal")
    balance = F.col("c_acctbal")
    got = reshape.derived_columns(c, renamed={"id": "c_custkey"}, first_of={"label": ["mark", "c_mktsegment"]}, joined={"full": (" / ", ["c_name", "mark"])}, cases={"band": [(balance < 0, "owes"), (balance > 5000, F.col("c_mktsegment"))]})
    return got.select("id", "label", "full", "band")


_SALES = """f AS (SELECT * FROM orders WHERE lower(substr(o_orderpriority, 3, 20)) IN ('urgent', 'high') QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""
ORACLE = {
    "seeded_sample": f"SELECT o_orderkey FROM orders WHERE ('0x' || substr(md5(o_orderkey || '/42'), 1, 8))::BIGINT < {int(0.1 * (1 << 32))}",
    "staff_dim": "SELECT s_suppkey::VARCHAR AS staff_id, s_name AS full_name, lower(s_name) || '@corp.com' AS email FROM supplier",
    "activity_fact": "SELECT event_id AS id, user_id AS lead_id, s_name AS staff_name FROM events LEFT JOIN supplier ON user_id = s_suppkey",
    "lead_dim": "SELECT c_custkey AS lead_id, CASE WHEN c_nationkey > 20 THEN c_mktsegment ELSE c_name END AS name, c_mktsegment AS status_label, CASE WHEN c_acctbal < 0 THEN c_nationkey::BIGINT END AS merged_into FROM customer",
    "sales_fact": f"WITH {_SALES} SELECT o_custkey AS lead_id, o_orderdate::DATE AS date_of_sale, o_totalprice AS price, o_orderstatus AS state FROM f",
    "sales_gap_report": f"WITH {_SALES} SELECT c_custkey AS lead_id, CASE WHEN c_custkey % 7 = 0 THEN 'merged away' WHEN c_mktsegment = 'BUILDING' THEN 'not a client' ELSE 'sale missing' END AS reason FROM customer WHERE c_acctbal > 0 AND c_custkey NOT IN (SELECT o_custkey FROM f)",
    "health_metrics": "SELECT c_custkey AS lead_id, spend, c_mktsegment LIKE 'AUTO%' AS is_intern, spend IS NULL AS is_unlinked FROM customer LEFT JOIN (SELECT o_custkey, round(sum(o_totalprice), 2) AS spend FROM orders GROUP BY 1) ON o_custkey = c_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') OR c_mktsegment LIKE 'AUTO%'",
    "days_since_login": "SELECT user_id AS c_custkey, max(ts::DATE) AS last_access, date_diff('day', max(ts::DATE), DATE '2024-01-31')::INT AS days, date_diff('day', max(ts::DATE), DATE '2024-01-31')::VARCHAR AS shown FROM events JOIN customer ON c_custkey = user_id WHERE event_type = 'view' GROUP BY 1",
    "attributed_sales": "WITH b AS (SELECT s_suppkey % 80 AS code, min(s_nationkey) AS owner FROM supplier GROUP BY 1 HAVING count(DISTINCT s_nationkey) = 1) SELECT o_orderkey, owner FROM orders LEFT JOIN b ON code = o_custkey % 80",
    "days_until_next_by_spine": "WITH h AS (SELECT c_custkey // 4 AS g, ts FROM events JOIN customer ON c_custkey = user_id UNION SELECT c_custkey // 4, ts FROM events JOIN customer ON c_custkey = user_id + 1 AND c_custkey % 2 = 1), n AS (SELECT g, min(ts) AS next_at FROM h WHERE ts::DATE >= DATE '2024-01-15' GROUP BY 1) SELECT c_custkey AS lead_id, next_at, date_diff('day', DATE '2024-01-15', next_at::DATE)::INT AS days FROM customer JOIN n ON g = c_custkey // 4",
    "derived_columns": "SELECT c_custkey AS id, CASE WHEN c_nationkey BETWEEN 5 AND 19 THEN 'n' ELSE c_mktsegment END AS label, c_name || CASE WHEN c_nationkey BETWEEN 5 AND 19 THEN ' / n' ELSE '' END AS \"full\", CASE WHEN c_acctbal < 0 THEN 'owes' WHEN c_acctbal > 5000 THEN c_mktsegment END AS band FROM customer",
    "group_counts": "SELECT o_orderstatus, count(*) AS n, count(DISTINCT o_totalprice) AS n_distinct, min(o_totalprice) AS least, max(o_totalprice) AS most, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 2) AS mean FROM orders GROUP BY 1",
    "conditional_agg": "SELECT user_id, max(ts) FILTER (event_type = 'click') AS click, max(ts) FILTER (event_type = 'view') AS view FROM events GROUP BY 1",
    "collect_set_sorted": "SELECT c_nationkey, array_to_string(list_sort(list(DISTINCT c_mktsegment)), ' / ') AS \"values\" FROM customer GROUP BY 1",
    "having_filter": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING n BETWEEN 5 AND 12",
    "rank_window": "SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)::INT AS rank FROM orders QUALIFY rank <= 3",
    "rank_then_filter": "SELECT o_custkey, o_orderkey FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) WHERE o_orderstatus = 'F'",
    "top_n": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    "union_distinct": "SELECT c_nationkey AS n FROM customer UNION SELECT s_nationkey FROM supplier",
    "union_all": "SELECT n, kind, count(*) AS rows FROM (SELECT c_nationkey AS n, 'c' AS kind FROM customer UNION ALL SELECT s_nationkey, NULL FROM supplier) GROUP BY ALL",
    "cross_scalar": "SELECT o_orderstatus, round(count(*) / (SELECT count(*) FROM orders), 6) AS share FROM orders GROUP BY 1",
    "self_join_versions": "SELECT o_custkey, o_orderkey, o_orderstatus, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS old_o_orderstatus FROM orders",
}
_ALL = (staff_dim, activity_fact, lead_dim, sales_fact, sales_gap_report, health_metrics, days_since_login, group_counts, conditional_agg, collect_set_sorted, having_filter, rank_window, rank_then_filter, top_n, seeded_sample, union_distinct, union_all, cross_scalar, self_join_versions, attributed_sales, days_until_next_by_spine, derived_columns)
QUERIES = {f.__name__: f for f in _ALL}
