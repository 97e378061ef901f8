"""Dimensions and facts of customer records, composed from the other operators.

Inputs are tables with the columns that the docstrings name; identity comes from a spine of people (identity_spine).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.dedup import latest_per_key
from strata.operators.joins import array_membership_join, enrich_left, unique_bridge_join
from strata.operators.metrics import days_until_next


def _latest(df: DataFrame, key: str, *clocks: str) -> DataFrame:
    known = [c for c in clocks if c in df.columns]
    order = [F.col(c).desc_nulls_last() for c in known] + [F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in df.columns]).desc()]
    return latest_per_key(df, [key], order, keep_null_keys=False)


def staff_dim(users: DataFrame) -> DataFrame:
    """Users (id, email, first_name, last_name, date_updated): the latest profile of each, full name and normalised e-mail."""
    u = _latest(users, "id", "date_updated", "bronze_insert_date")
    name = F.nullif(F.trim(F.concat_ws(" ", "first_name", "last_name")), F.lit(""))
    return u.select(F.col("id").alias("staff_id"), name.alias("full_name"), F.nullif(F.lower(F.trim("email")), F.lit("")).alias("email"))


def activity_fact(activities: DataFrame, staff: DataFrame, *, by: str = "created_by") -> DataFrame:
    """Activities (id, lead_id, type, activity_at, ...): the latest version of each, with the staff member's name."""
    a = _latest(activities, "id", "date_updated", "activity_at")
    return enrich_left(a, staff.select(F.col("staff_id").alias(by), F.col("full_name").alias("staff_name")), by)


def lead_dim(leads: DataFrame, *, emails: DataFrame | None = None, names: DataFrame | None = None, custom: DataFrame | None = None, merges: DataFrame | None = None) -> DataFrame:
    """All leads (id, name, status_label, date_updated), each once.

    With: emails (lead_id, values, primary) of owner_blocklist; names (lead_id, name) of extract_names, taken where the lead has none;
    custom attributes (lead_id, ...); merges (loser, root) of merge_map as ``merged_into``.
    """
    out = _latest(leads, "id", "date_updated", "bronze_insert_date").withColumnRenamed("id", "lead_id")
    if names is not None:
        out = enrich_left(out, names.select("lead_id", F.col("name").alias("__found")), "lead_id").withColumn("name", F.coalesce(F.nullif(F.trim("name"), F.lit("")), "__found")).drop("__found")
    if emails is not None:
        out = enrich_left(out, emails.select("lead_id", F.col("values").alias("emails"), F.col("primary").alias("primary_email")), "lead_id")
    if custom is not None:
        out = enrich_left(out, custom, "lead_id")
    if merges is not None:
        out = enrich_left(out, merges.select(F.col("loser").alias("lead_id"), F.col("root").alias("merged_into")), "lead_id")
    return out


def ids_by_name(defs: DataFrame, names: Sequence[str], *, name: str = "name", id_: str = "id") -> dict[str, list[str]]:
    """{name: ids} of the definitions with these names, in any case: ids are never hard-coded. A few rows to the driver."""
    rows = defs.where(F.lower(F.trim(name)).isin([n.lower() for n in names])).select(F.lower(F.trim(name)).alias("n"), id_).distinct().collect()
    return {n: sorted(r[id_] for r in rows if r["n"] == n.lower()) for n in names}


def sales_fact(activities: DataFrame, types: DataFrame, fields: DataFrame, *, sale_types: Sequence[str], values: dict[str, str]) -> DataFrame:
    """The latest sale of each lead: activities (lead_id, custom_activity_type_id, activity_at, custom_fields MAP) of the named types; ``values`` names output columns by field name."""
    kinds = [i for ids in ids_by_name(types, sale_types).values() for i in ids]
    found = ids_by_name(fields, list(values.values()))
    sales = _latest(activities.where(F.col("custom_activity_type_id").isin(kinds)), "lead_id", "activity_at", "date_updated")

    def read(field: str) -> Column:
        keys = [k for i in found[field] for k in (i, f"cf_{i}")]
        return F.coalesce(*[F.try_element_at("custom_fields", F.lit(k)) for k in keys]) if keys else F.lit(None).cast("string")

    return sales.select("lead_id", F.to_date("activity_at").alias("date_of_sale"), *[read(f).alias(c) for c, f in values.items()])


def sales_gap_report(leads: DataFrame, sales: DataFrame, *, value: str = "contract_value", merges: DataFrame | None = None, clients: DataFrame | None = None) -> DataFrame:
    """(lead_id, reason): leads with a contract value and no sale, because they were merged away, are no clients, or miss the sale."""
    gap = leads.where(F.col(value) > 0).select("lead_id").join(sales.select("lead_id").distinct(), "lead_id", "left_anti")
    merged = (merges.select(F.col("loser").alias("lead_id")) if merges is not None else gap.select("lead_id").limit(0)).distinct().withColumn("__m", F.lit(True))
    client = (clients.select("lead_id") if clients is not None else gap.select("lead_id")).distinct().withColumn("__c", F.lit(True))
    reason = F.when(F.col("__m"), "merged away").when(F.col("__c").isNull(), "not a client").otherwise("sale missing")
    return gap.join(merged, "lead_id", "left").join(client, "lead_id", "left").select("lead_id", reason.alias("reason"))


def days_until_next_by_spine(events: DataFrame, spine: DataFrame, pairs: Sequence[tuple[str, str]], *, ts_col: str, as_of) -> DataFrame:
    """(lead_id, next_at, days): the soonest event on or after ``as_of`` that reaches a person's leads through the spine's arrays."""
    ahead = events.where(F.to_date(ts_col) >= F.lit(str(as_of)).cast("date"))
    hits = array_membership_join(ahead, spine.withColumn("leads", F.col("lead_ids")), pairs, left_keep=[ts_col], right_keep=["group_key"])
    leads = spine.select("group_key", F.explode("lead_ids").alias("lead_id"))
    return days_until_next(hits.join(leads, "group_key"), "lead_id", ts_col, as_of=as_of)


def health_metrics(leads: DataFrame, metrics: dict[str, DataFrame], *, client_status: Sequence[str], status: str = "status_label", intern_pattern: str = "(?i)intern") -> DataFrame:
    """Clients (leads whose latest status is one of ``client_status``) with every metric table's columns, and flags.

    Each metric table has one row a lead. Flags: is_intern (by status), is_unlinked (no metric at all), no_email.
    """
    out = leads.where(F.lower(status).isin([s.lower() for s in client_status]) | F.coalesce(F.col(status).rlike(intern_pattern), F.lit(False)))
    own = set(out.columns)
    for m in metrics.values():
        out = enrich_left(out, m, "lead_id")
    added = [c for c in out.columns if c not in own]
    no_email = F.col("primary_email").isNull() if "primary_email" in own else F.lit(True)
    return out.withColumns({"is_intern": F.coalesce(F.col(status).rlike(intern_pattern), F.lit(False)), "is_unlinked": F.coalesce(*[F.col(c).cast("string") for c in added]).isNull() if added else F.lit(True), "no_email": no_email})


def attributed_sales(sales: DataFrame, bridge: DataFrame, *, value: str, owner: str) -> DataFrame:
    """Sales with the owner of their value, where it has one only."""
    return unique_bridge_join(sales, bridge, value, owner)
