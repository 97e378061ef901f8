"""Identity resolution over (hash, link) edges, and what is read off it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.graph import components
from strata.functions.shared import stage
from strata.operators.joins import array_membership_join, unique_bridge_join


@dataclass
class Branch:
    """One source of identities: columns for each role; missing roles are null."""

    df: DataFrame
    source: str
    column: str
    roles: dict[str, str | Column]


ROLES = ("hash", "lead_id", "contact_id", "activity_id", "email")


def collect_identities(branches: Sequence[Branch]) -> DataFrame:
    """(hash, lead_id, contact_id, activity_id, email, source, column): all branches, e-mails trimmed and lower-cased once; rows without hash and e-mail go."""
    parts = []
    for b in branches:
        cols = [(F.col(r) if isinstance(r := b.roles.get(x), str) else r if r is not None else F.lit(None)).cast("string").alias(x) for x in ROLES]
        parts.append(b.df.select(*cols, F.lit(b.source).alias("source"), F.lit(b.column).alias("column")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.withColumn("email", F.nullif(F.lower(F.trim("email")), F.lit("")))
    return out.where("hash IS NOT NULL OR email IS NOT NULL").distinct()


def identities_by_email(edges: DataFrame) -> DataFrame:
    """Sets of hashes, leads and sources of each e-mail, and their sizes."""
    known = edges.where("email IS NOT NULL").groupBy("email")
    return known.agg(*[F.array_sort(F.collect_set(c)).alias(f"{n}s") for c, n in (("hash", "hash"), ("lead_id", "lead"), ("source", "source"))]).withColumns({f"n_{n}s": F.size(f"{n}s") for n in ("hash", "lead", "source")})


def guarded_edges(edges: DataFrame, node: str, link: str, max_links_per_node: int, max_nodes_per_link: int, *, counted: DataFrame | None = None) -> DataFrame:
    """Distinct (node, link) pairs, without nodes of too many links and links of too many nodes, by the counts in ``counted`` or ``edges`` itself."""
    e = edges.select(F.col(node).alias("node"), F.col(link).alias("link")).where("node IS NOT NULL AND link IS NOT NULL").distinct()
    c = e if counted is None else counted.select(F.col(node).alias("node"), F.col(link).alias("link")).where("node IS NOT NULL AND link IS NOT NULL").distinct()
    wide = c.groupBy("node").count().where(F.col("count") > max_links_per_node).select("node")
    shared = c.groupBy("link").count().where(F.col("count") > max_nodes_per_link).select("link")
    return e.join(wide, "node", "left_anti").join(shared, "link", "left_anti")


def _closure(safe: DataFrame) -> DataFrame:
    """(node, group_key) of guarded edges: each link is one edge a node, to its smallest node."""
    low = safe.join(safe.groupBy("link").agg(F.min("node").alias("low")), "link").select("node", "low")
    return components(low, "node", "low").withColumnRenamed("component", "group_key")


def identity_groups(edges: DataFrame, *, node: str = "hash", link: str = "email", max_links_per_node: int = 10, max_nodes_per_link: int = 5, hops: int | None = None) -> DataFrame:
    """(node, group_key): with hops=1 the smallest node one shared link away, else the smallest node of the whole component.

    Guards come first. Two aggregates replace a self-join for one hop: MIN per link, then MIN per node. Nodes without a usable link are
    their own group.
    """
    nodes = edges.select(F.col(node).alias("node")).where("node IS NOT NULL").distinct()
    safe = guarded_edges(edges, node, link, max_links_per_node, max_nodes_per_link)
    if hops == 1:
        low = safe.groupBy("link").agg(F.min("node").alias("low"))
        groups = safe.join(low, "link").groupBy("node").agg(F.min("low").alias("group_key"))
    elif hops is None:
        groups = _closure(safe)
    else:
        raise ValueError("hops is 1 or None")
    return nodes.join(groups, "node", "left").select("node", F.coalesce("group_key", "node").alias("group_key"))


def update_groups(groups: DataFrame, edges: DataFrame, new: DataFrame, *, node: str = "hash", link: str = "email", max_links_per_node: int = 10, max_nodes_per_link: int = 5) -> DataFrame:
    """identity_groups of ``edges`` and ``new`` together, from the ``groups`` of ``edges``: only groups that the new edges touch are closed anew.

    A group is touched if a new edge has one of its nodes, or a link that one of its nodes has: a link or a node that the new edges make too wide
    splits its group. All edges of touched groups, and they alone, go into the closure; links count all their nodes. The rest keeps its keys.
    """
    pick = lambda df: df.select(F.col(node).alias("node"), F.col(link).alias("link")).where("node IS NOT NULL")
    fresh = stage(pick(new).distinct(), "new-edges")
    every = pick(edges).unionByName(fresh)
    links = fresh.select("link").where("link IS NOT NULL").distinct()
    touched = every.join(links, "link", "left_semi").select("node").unionByName(fresh.select("node")).distinct()
    keys = groups.join(touched, "node", "left_semi").select("group_key").distinct()
    members = stage(groups.join(keys, "group_key", "left_semi").select("node").unionByName(touched).distinct(), "members")
    own = stage(every.join(members, "node", "left_semi").distinct(), "own-edges")
    counted = every.join(own.select("link").distinct(), "link", "left_semi").unionByName(own)
    closed = _closure(guarded_edges(own, "node", "link", max_links_per_node, max_nodes_per_link, counted=counted))
    anew = members.join(closed, "node", "left").select("node", F.coalesce("group_key", "node").alias("group_key"))
    return groups.join(members, "node", "left_anti").select("node", "group_key").unionByName(anew)


def identity_spine(edges: DataFrame, groups: DataFrame, *, masked: str = r"@(masked|anon|privaterelay)") -> DataFrame:
    """One row a person: sorted sets of hashes, real and masked e-mails, leads, contacts and sources."""
    e = edges.join(groups.withColumnRenamed("node", "hash"), "hash")
    is_masked = F.col("email").rlike(masked)
    sets = {"hashes": F.col("hash"), "real_emails": F.when(~is_masked, F.col("email")), "masked_emails": F.when(is_masked, F.col("email")), "lead_ids": F.col("lead_id"), "contact_ids": F.col("contact_id"), "sources": F.col("source")}
    return e.groupBy("group_key").agg(*[F.array_sort(F.collect_set(c)).alias(n) for n, c in sets.items()])


def dense_id(df: DataFrame, key: str, *, out: str = "dense_id") -> DataFrame:
    """1, 2, 3, ... over the sorted distinct keys, without sorting them all in one task: range partitions, and an offset for each."""
    ranged = stage(df.select(key).where(F.col(key).isNotNull()).distinct().repartitionByRange(key).withColumn("__p", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("__p").agg(F.count("*").alias("n"))
    offsets = sizes.select("__p", (F.sum("n").over(Window.orderBy("__p")) - F.col("n")).alias("before"))  # a row for each partition
    ranked = ranged.withColumn("__r", F.row_number().over(Window.partitionBy("__p").orderBy(key)))
    ids = ranked.join(F.broadcast(offsets), "__p").select(key, (F.col("before") + F.col("__r")).alias(out))
    return df.join(ids, key, "left")


def spine_coverage(spine: DataFrame, events: DataFrame, pairs: Sequence[tuple[str, str]], *, event_id: str) -> DataFrame:
    """(events, reached, people): events whose keys are in a person's arrays, and how many people they reach."""
    hits = array_membership_join(events, spine, pairs, left_keep=[event_id], right_keep=["group_key"])
    total = events.agg(F.count_distinct(event_id).alias("events"))
    return total.crossJoin(hits.agg(F.count_distinct(event_id).alias("reached"), F.count_distinct("group_key").alias("people")))


def staff_classify(spine: DataFrame, registered: DataFrame, *, domain: str, marker_pattern: str | None = None, registered_col: str = "email") -> DataFrame:
    """The spine with is_staff: any e-mail of the domain, any registered e-mail, or any hash of the marker's shape makes the whole person staff."""
    emails = F.array_union("real_emails", "masked_emails")
    mark = F.exists(emails, lambda e: e.endswith(f"@{domain.lower()}"))
    if marker_pattern:
        mark |= F.exists("hashes", lambda h: h.rlike(marker_pattern))
    known = registered.select(F.lower(F.trim(registered_col)).alias("email")).distinct()
    hit = spine.select("group_key", F.explode(emails).alias("email")).join(known, "email", "left_semi").select("group_key").distinct().withColumn("__hit", F.lit(True))
    return spine.join(hit, "group_key", "left").withColumn("is_staff", F.coalesce("__hit", F.lit(False)) | F.coalesce(mark, F.lit(False))).drop("__hit")


def owner_blocklist(links: DataFrame, blocked: DataFrame, *, owner: str, value: str, own: str, real: str) -> DataFrame:
    """(owner, values, primary): an owner's values that aren't blocked, sorted; the primary one by own and real, real, own, any, then alphabet."""
    free = links.join(blocked.select(value).distinct(), value, "left_anti").where(F.col(value).isNotNull())
    rank = F.when(F.col(own) & F.col(real), 0).when(F.col(real), 1).when(F.col(own), 2).otherwise(3)
    return free.groupBy(owner).agg(F.array_sort(F.collect_set(value)).alias("values"), F.min_by(value, F.struct(rank, F.col(value))).alias("primary"))


def role_attribution(facts: DataFrame, bridge: DataFrame, *, value: str, owner: str, roles: dict[str, Column]) -> DataFrame:
    """(owner, a count for each role): facts attributed over bridge values of one owner only."""
    owned = unique_bridge_join(facts, bridge, value, owner).where(F.col(owner).isNotNull())
    return owned.groupBy(owner).agg(*[F.count_if(c).alias(n) for n, c in roles.items()])


# fixed values: words that follow a greeting and are no name, and the pattern of a greeting with a name
STOP_WORDS = ("there", "everyone", "everybody", "friend", "buddy", "man", "dude", "brother", "bro", "boss", "team", "guys", "folks", "yes", "no", "quick", "hi", "hello", "hey", "you", "it")
GREETING = r"(?:Hey|Hi|Hello)\s+([A-Za-z]+)\s*[,!\.]"


def extract_names(df: DataFrame, key: str, sources: Sequence[tuple[Column, str, bool]], *, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """(key, name, rung): names found by the first source that has any, joined by `` / ``.

    A source is (text, pattern with one group, whether it is a greeting). Greeted names skip the stop words, and all-lower or all-upper ones
    are capitalised.
    """
    parts = []
    for rung, (text, pattern, greeting) in enumerate(sources, 1):
        name = F.trim(F.regexp_extract(text, pattern, 1))
        rows = df.select(key, F.lit(rung).alias("rung"), name.alias("n")).where("n <> ''").where(~F.col("n").startswith("user_"))
        if greeting:
            n = F.col("n")
            rows = rows.where(~F.lower("n").isin(list(stop_words))).withColumn("n", F.when((n == F.lower(n)) | (n == F.upper(n)), F.initcap(n)).otherwise(n))
        parts.append(rows)
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    sets = rows.groupBy(key, "rung").agg(F.array_join(F.array_sort(F.collect_set("n")), " / ").alias("name"))
    return sets.groupBy(key).agg(F.min_by("name", "rung").alias("name"), F.min("rung").alias("rung"))
