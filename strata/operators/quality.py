"""Keys, relationships, drift detectors and fleet health, each over all rows."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.shared import free_name, stage

_KEYS = (T.StringType, T.IntegerType, T.LongType)
#: Expressions in one aggregate: more may exceed the size of a generated method.
CHUNK = 150


def _one_row(df: DataFrame, named: dict[str, Column]) -> dict:
    out: dict = {}
    items = list(named.items())
    for i in range(0, len(items), CHUNK):
        out |= df.agg(*[c.alias(n) for n, c in items[i : i + CHUNK]]).first().asDict()
    return out


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def key_candidates(df: DataFrame, *, table: str = "") -> list[str]:
    """Columns that may be the key, best first: id, <table>_id, then *_id and *key."""
    names = [f.name for f in df.schema if isinstance(f.dataType, _KEYS)]
    rank = lambda n: 0 if n.lower() == "id" else 1 if n.lower() == f"{table.lower()}_id" else 2 if n.lower().endswith("_id") else 3
    return sorted([n for n in names if n.lower() == "id" or n.lower().endswith(("_id", "key"))], key=lambda n: (rank(n), names.index(n)))


def find_key(df: DataFrame, *, table: str = "") -> str | None:
    """The first candidate that is unique among its non-null values, tested over all rows.

    One pass of approximate counts drops those that are far from unique; the others are tested exactly, best first, each by an
    aggregate of its own, which doesn't multiply rows by the number of candidates.
    """
    names = key_candidates(df, table=table)
    if not names:
        return None
    got = _one_row(df, {f"n{i}": F.count(F.col(f"`{c}`")) for i, c in enumerate(names)} | {f"d{i}": F.approx_count_distinct(F.col(f"`{c}`"), 0.02) for i, c in enumerate(names)})
    for i, c in enumerate(names):
        if got[f"n{i}"] and got[f"d{i}"] >= 0.85 * got[f"n{i}"] and df.select(F.col(f"`{c}`").alias("k")).where("k IS NOT NULL").groupBy("k").count().where("count > 1").isEmpty():
            return c
    return None


def mapping_keys(df: DataFrame, inherited: Sequence[str] = ()) -> list[str]:
    """Non-null unique columns that don't come from the parent. Counted as in find_key: approximately for all at once, exactly for those that may be unique, one by one."""
    names = [f.name for f in df.schema if isinstance(f.dataType, _KEYS) and f.name not in inherited]
    if not names:
        return []
    got = _one_row(df, {"n": F.count("*")} | {f"d{i}": F.approx_count_distinct(F.col(f"`{c}`"), 0.02) for i, c in enumerate(names)} | {f"n{i}": F.count(F.col(f"`{c}`")) for i, c in enumerate(names)})
    likely = [c for i, c in enumerate(names) if got["n"] and got[f"n{i}"] == got["n"] and got[f"d{i}"] >= 0.85 * got["n"]]
    return [c for c in likely if df.groupBy(F.col(f"`{c}`")).count().where("count > 1").isEmpty()]


#: Values of a column that a sketch holds at most, about; and the odds at which a pair that is contained enough may be taken for one that isn't.
SKETCH, MISS = 4096, 1e-12
_BLANKS = ("", "None", "nan", "NaN")  # fixed values: texts that stand for no value


def _values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(c, v): the values of each column, by its index, as text; blanks left out."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for i, c in enumerate(columns)]))
    return df.select(pairs.alias("p")).select("p.c", "p.v").where(F.col("v").isNotNull() & ~F.trim("v").isin(*_BLANKS))


def column_sketches(tables: dict[str, DataFrame], columns: dict[str, Sequence[str]], *, size: int = SKETCH) -> dict[tuple[str, str], tuple[int, list[int]]]:
    """For each (table, column): how high its sampled hashes go, and the hashes: all distinct values that hash below, about ``size`` of them.

    One pass for approximate counts, one that keeps the few values below each column's bound; values aren't shuffled otherwise.
    """
    out = {}
    for t, names in columns.items():
        if not names:
            continue
        counts = _one_row(tables[t], {f"c{i}": F.approx_count_distinct(F.col(f"`{c}`").cast("string")) for i, c in enumerate(names)})
        bound = [min(1.0, size / max(1, counts[f"c{i}"])) for i in range(len(names))]
        tops = [int(b * (1 << 62)) for b in bound]
        h = F.shiftrightunsigned(F.xxhash64("v"), 2)
        top = F.element_at(F.array(*[F.lit(x) for x in tops]), F.col("c") + 1)
        kept = _values(tables[t], names).select("c", h.alias("h")).where(F.col("h") < top).distinct().groupBy("c").agg(F.collect_list("h").alias("hs"))
        found = {r["c"]: sorted(r["hs"]) for r in kept.collect()}
        out |= {(t, c): (tops[i], found.get(i, [])) for i, c in enumerate(names)}
    return out


def _may_contain(left: tuple[int, list[int]], right: tuple[int, list[int]], least: float) -> bool:
    """Whether the sketches leave it open that ``least`` of the left column's values lie in the right one (Hoeffding's bound, at MISS)."""
    top, right_set = min(left[0], right[0]), set(right[1])
    mine = [h for h in left[1] if h < top]
    if not mine:
        return bool(right[1]) or right[0] < 1 << 62
    hits = sum(h in right_set for h in mine)
    slack = math.sqrt(-math.log(MISS) / (2 * len(mine))) if top < 1 << 62 else 0.0  # below the top of all hashes, sketches are whole
    return hits >= (least - slack) * len(mine)


def _containments(tables: dict[str, DataFrame], pairs: Sequence[tuple[tuple[str, str], tuple[str, str]]]) -> DataFrame:
    """(left_table, left_col, right_table, right_col, left_n, right_n, shared) of pairs of columns: distinct values and how many of the left's are in the right, exactly.

    Each column's distinct values are found once; a value is joined for the pairs of its column alone.
    """
    spark = next(iter(tables.values())).sparkSession
    schema = "left_table string, left_col string, right_table string, right_col string, left_n bigint, right_n bigint, shared bigint"
    if not pairs:
        return spark.createDataFrame([], schema)
    columns = sorted({c for p in pairs for c in p})
    by_table: dict[str, list] = {}
    for t, c in columns:
        by_table.setdefault(t, []).append(c)
    parts = [_values(tables[t], cs).distinct().select(F.element_at(F.array(*[F.lit(columns.index((t, c))) for c in cs]), F.col("c") + 1).alias("c"), "v") for t, cs in by_table.items()]
    values = stage(_union(parts), "key-values")
    of = lambda side: F.element_at(F.array(*[F.array(*[F.lit(i) for i, p in enumerate(pairs) if p[side] == c]).cast("array<int>") for c in columns]), F.col("c") + 1)
    left, right = (values.select(F.explode(of(side)).alias("pair"), "v") for side in (0, 1))
    shared = left.join(right, ["pair", "v"]).groupBy("pair").agg(F.count("*").alias("shared"))
    counts = {r["c"]: r["n"] for r in values.groupBy("c").agg(F.count("*").alias("n")).collect()}
    named = spark.createDataFrame([(i, a[0], a[1], b[0], b[1], counts.get(columns.index(a), 0), counts.get(columns.index(b), 0)) for i, (a, b) in enumerate(pairs)], "pair int, " + schema.rsplit(", ", 1)[0])
    return named.join(shared, "pair", "left").withColumn("shared", F.coalesce("shared", F.lit(0).cast("bigint"))).drop("pair")


def _foreign_columns(df: DataFrame, table: str, key: str | None) -> list[str]:
    """Columns that may point to another table: those named like keys, and all scalar ones of a table of custom fields."""
    scalar = [f.name for f in df.schema if isinstance(f.dataType, _KEYS)]
    return scalar if table.endswith("_custom") else [c for c in scalar if c == key or c.lower().endswith(("_id", "key")) or (key and c.endswith(f"_{key}"))]


def find_join_keys(tables: dict[str, DataFrame], *, primary: dict[str, str] | None = None, foreign: dict[str, Sequence[str]] | None = None, min_values: int = 30, min_containment: float = 0.9) -> DataFrame:
    """(left_table, left_col, right_table, right_col, left_n, right_n, containment): foreign columns whose distinct values lie in another table's key.

    Keys and foreign columns are found (find_key; names like keys) unless given. Sketches of all columns drop the pairs that can't reach
    ``min_containment``, at odds of MISS of being wrong; only those left are joined, exactly. Columns with fewer than ``min_values`` values say too little.
    """
    primary, foreign = _key_columns(tables, primary, foreign)
    pairs = [(a, b) for a, b in _surviving(tables, primary, foreign, min_containment) if a[1] in foreign.get(a[0], ())]
    found = _containments(tables, pairs)
    out = found.where(F.col("left_n") >= min_values).withColumn("containment", F.round(F.col("shared") / F.col("left_n"), 4)).where(F.col("containment") >= min_containment)
    return out.select("left_table", "left_col", "right_table", "right_col", "left_n", "right_n", "containment")


def _key_columns(tables, primary, foreign):
    primary = primary if primary is not None else {t: k for t, df in tables.items() if (k := find_key(df, table=t))}
    return primary, foreign if foreign is not None else {t: _foreign_columns(df, t, primary.get(t)) for t, df in tables.items()}


def _surviving(tables, primary, foreign, least: float) -> list:
    columns = {t: sorted({*foreign.get(t, ()), *([primary[t]] if t in primary else [])}) for t in tables}
    sketches = column_sketches(tables, columns)
    wanted = {((t, c), (p, k)) for t, cs in foreign.items() for c in cs for p, k in primary.items() if p != t}
    wanted |= {((t, c), (p, k)) for t, c in primary.items() for p, k in primary.items() if p != t}
    return sorted(x for x in wanted if _may_contain(sketches[x[0]], sketches[x[1]], least))


def key_map(tables: dict[str, DataFrame], *, primary: dict[str, str] | None = None, foreign: dict[str, Sequence[str]] | None = None, min_values: int = 30, min_containment: float = 0.9) -> DataFrame:
    """(kind, left_table, left_col, right_table, right_col, containment, left_n, right_n, rel_hash): all keys and what points to them, to be kept by table_sink.

    PK: a table's key, with its distinct values. PK_ECHO: a key whose values lie in a larger table's, or in an equal one's of the table it is named
    after: a parent's key carried along, no target of its own. PK_FK: a column whose values lie in a key that is no echo; rel_hash stands
    for the family of all columns that point there. Tables and columns are metadata: their pairs are weighed on the driver.
    """
    spark = next(iter(tables.values())).sparkSession
    primary, foreign = _key_columns(tables, primary, foreign)
    pairs = _surviving(tables, primary, foreign, min_containment)
    rows = [r.asDict() for r in _containments(tables, pairs).collect()]  # a row for each pair of columns
    sizes = {(r["left_table"], r["left_col"]): r["left_n"] for r in rows} | {(r["right_table"], r["right_col"]): r["right_n"] for r in rows}
    alone = [t for t, k in primary.items() if (t, k) not in sizes]
    for t in alone:
        sizes[t, primary[t]] = _values(tables[t], [primary[t]]).distinct().count()
    share = {((r["left_table"], r["left_col"]), (r["right_table"], r["right_col"])): r["shared"] / max(1, r["left_n"]) for r in rows}
    keys = {t: (t, k) for t, k in sorted(primary.items()) if sizes[t, k]}
    echo: dict[str, str] = {}
    for a in keys:
        for b in keys:
            if a in echo or b == a or b in echo or share.get((keys[a], keys[b]), 0) < min_containment:
                continue
            if sizes[keys[a]] < sizes[keys[b]] or (sizes[keys[a]] == sizes[keys[b]] and a.startswith(b + "_")):
                echo[a] = b
            elif sizes[keys[a]] == sizes[keys[b]] and b.startswith(a + "_"):
                echo[b] = a
    out = [("PK", *keys[t], None, None, None, sizes[keys[t]], None, None) for t in keys]
    out += [("PK_ECHO", *keys[a], *keys[b], None, sizes[keys[a]], sizes[keys[b]], None) for a, b in echo.items()]
    targets = {keys[t] for t in keys if t not in echo}
    found: dict[tuple, list] = {}
    for (left, right), s in share.items():
        if right in targets and left[1] in foreign.get(left[0], ()) and sizes[left] >= min_values and s >= min_containment:
            found.setdefault(right, []).append((left, s))
    for right, members in found.items():
        family = "|".join(sorted(f"{t}.{c}" for (t, c), _ in members)) + f"->{right[0]}.{right[1]}"
        out += [("PK_FK", *left, *right, round(s, 4), sizes[left], sizes[right], hashlib.md5(family.encode()).hexdigest()[:8]) for left, s in members]
    return spark.createDataFrame(out, "kind string, left_table string, left_col string, right_table string, right_col string, containment double, left_n bigint, right_n bigint, rel_hash string")


def rel_hash(rel: DataFrame) -> DataFrame:
    """The relations with a stable hash of their family (the key they point to)."""
    return rel.withColumn("rel_hash", F.md5(F.concat_ws(".", "right_table", "right_col")))


def table_lineage(spark: SparkSession, tables: dict[str, T.StructType]) -> DataFrame:
    """(parent, child, depth, how): a table's parent is the one with the longest name that its own begins with and an underscore follows.

    how: ``array`` if the rest is an array column of the parent's, ``custom`` for a table of custom fields, else ``prefix``; null for tables without a parent.
    """
    parent = {c: max((p for p in tables if c.startswith(f"{p}_")), key=len, default=None) for c in tables}

    def depth(t):
        return 0 if parent[t] is None else 1 + depth(parent[t])

    def how(t):
        if (p := parent[t]) is None:
            return None
        rest = t.removeprefix(f"{p}_")
        return "array" if any(f.name == rest and isinstance(f.dataType, T.ArrayType) for f in tables[p]) else "custom" if rest == "custom" else "prefix"

    return spark.createDataFrame([(parent[t], t, depth(t), how(t)) for t in sorted(tables)], "parent string, child string, depth int, how string")


def type_conflicts(df: DataFrame, raw_col: str, parsed_col: str, *, min_share: float = 0.005) -> DataFrame:
    """(field, problem, n, share): fields present in the raw JSON but null once parsed, and text that hides JSON, on at least ``min_share`` of rows."""
    raw = F.from_json(F.when(F.try_parse_json(raw_col).isNotNull(), F.col(raw_col)), "map<string,string>")
    fields = list(df.schema[parsed_col].dataType)
    held = free_name(df, "raw_fields")
    df = df.withColumn(held, raw)
    tests: dict[tuple[str, str], Column] = {}
    for f in fields:
        parsed, text = F.col(f"{parsed_col}.`{f.name}`"), F.try_element_at(held, F.lit(f.name))
        tests[f.name, "lost"] = text.isNotNull() & (text != "null") & parsed.isNull()
        if isinstance(f.dataType, T.StringType):
            tests[f.name, "hidden json"] = parsed.rlike(r"^\s*[\[{]") & F.try_parse_json(parsed).isNotNull()
    one = df.agg(F.count("*").alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(f"c{i}") for i, c in enumerate(tests.values())])
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.lit(p).alias("problem"), F.col(f"c{i}").alias("n")) for i, (n, p) in enumerate(tests)])).alias("r")
    return one.select("rows", rows).select("r.*", F.round(F.col("r.n") / F.greatest("rows", F.lit(1)), 4).alias("share")).where((F.col("share") >= min_share) & (F.col("n") > 0))


def null_hygiene(df: DataFrame) -> DataFrame:
    """(column, nulls, rows, all_null) of every column, and the row ``*`` for rows with no value at all."""
    names = df.columns
    empty = F.lit(True)
    for c in names:
        empty &= F.col(f"`{c}`").isNull()
    one = df.agg(F.count("*").alias("rows"), F.count_if(empty).alias("c_all"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(names)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("nulls")) for i, c in enumerate(names)] + [F.struct(F.lit("*").alias("column"), F.col("c_all").alias("nulls"))]
    return one.select("rows", F.explode(F.array(*rows)).alias("r")).select("r.column", "r.nulls", "rows", (F.col("r.nulls") == F.col("rows")).alias("all_null"))


def all_null_guard(df: DataFrame) -> None:
    """Raise when there are rows and every field is null on all of them."""
    got = _one_row(df, {"n": F.count("*")} | {f"c{i}": F.count(F.col(f"`{c}`")) for i, c in enumerate(df.columns)})
    if got["n"] and not any(v for k, v in got.items() if k != "n"):
        raise ValueError("every field is null on every row")


def literal_leaks(df: DataFrame) -> DataFrame:
    """(column, n): texts equal to None, True or False."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    one = df.agg(*[F.count_if(F.col(f"`{c}`").isin("None", "True", "False")).alias(f"c{i}") for i, c in enumerate(names)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("n")) for i, c in enumerate(names)])).alias("r")).select("r.*").where("n > 0")


def deletion_drift(df: DataFrame, key: str, ts_col: str, n: int = 3) -> DataFrame:
    """(key, last_seen): keys absent from the ``n`` newest dumps."""
    newest = df.select(F.col(ts_col).alias("at")).where("at IS NOT NULL").distinct().orderBy(F.col("at").desc()).limit(n).agg(F.min("at").alias("cut"))
    last = df.groupBy(F.col(key).alias("of")).agg(F.max(ts_col).alias("last_seen"))
    return last.crossJoin(F.broadcast(newest)).where("last_seen < cut").select(F.col("of").alias(key), "last_seen")


def key_class(c: Column) -> Column:
    c = c.cast("string")
    return F.when(c.rlike(r"^\d+$"), "numeric").when(c.rlike(r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"), "uuid").when(c.isNotNull(), "other")


def key_format_drift(df: DataFrame, key: str, ts_col: str) -> DataFrame:
    """(month, classes, mixed, flipped): key classes of each month, and whether they are mixed or differ from the month before."""
    m = df.where(F.col(key).isNotNull()).groupBy(F.date_format(ts_col, "yyyy-MM").alias("month")).agg(F.array_sort(F.collect_set(key_class(F.col(key)))).alias("classes"))
    m = m.withColumn("classes", F.array_join("classes", ","))
    before = F.lag("classes").over(Window.orderBy("month"))  # a row for each month
    return m.select("month", "classes", F.contains("classes", F.lit(",")).alias("mixed"), F.coalesce(before != F.col("classes"), F.lit(False)).alias("flipped"))


def dynamic_key_maps(df: DataFrame, col: str, frac: float = 0.01) -> DataFrame:
    """(key, n, share): JSON keys in at most ``frac`` of the rows."""
    total = df.agg(F.count("*").alias("rows"))
    counts = df.select(F.explode(F.json_object_keys(col)).alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    return counts.crossJoin(F.broadcast(total)).select("key", "n", F.round(F.col("n") / F.col("rows"), 6).alias("share")).where(F.col("share") <= frac)


def epoch_unit_drift(df: DataFrame, floor: int = 1990) -> DataFrame:
    """(column, n): dates and timestamps before the year ``floor``."""
    names = [f.name for f in df.schema if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    one = df.agg(*[F.count_if(F.year(F.col(f"`{c}`")) < floor).alias(f"c{i}") for i, c in enumerate(names)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("n")) for i, c in enumerate(names)])).alias("r")).select("r.*")


def field_budget(run_log: DataFrame, budget: int = 1000) -> DataFrame:
    """Tables whose discovered fields exceed the budget."""
    return run_log.groupBy("silver_name").agg(F.max("fields_discovered").alias("fields")).where(F.col("fields") > budget)


def event_time_format(df: DataFrame, col: str) -> DataFrame:
    """(format, length, n): texts by shape; more than one row means they don't sort as time."""
    c = F.col(col).cast("string")
    cls = F.when(c.isNull(), "null").when(c.rlike(r"^\d{4}-\d\d-\d\d$"), "date").when(c.rlike(r"^\d{4}-\d\d-\d\dT"), "iso").when(c.rlike(r"^\d{4}-\d\d-\d\d "), "spaced").when(c.rlike(r"^\d+$"), "epoch").otherwise("other")
    return df.groupBy(cls.alias("format"), F.coalesce(F.length(c), F.lit(0)).alias("length")).agg(F.count("*").alias("n"))


def event_time_regressions(df: DataFrame, key: str, arrival: str, event: str) -> DataFrame:
    """(key, arrival, event, before): rows that arrived later than one with a later event time, by arrival order."""
    before = F.lag(event).over(Window.partitionBy(key).orderBy(arrival, event))
    return df.select(key, arrival, event, before.alias("before")).where(F.col(event) < F.col("before"))


# fixed values: the default limits of fleet_health
LIMITS = {"empty_streak": 3, "stale_hours": 48, "parse_rate": 0.5, "field_jump": 10, "rebuilds": 3, "rebuild_days": 7, "quarantine_day": 50, "rung_shift": 25.0, "fields": 1000}


def fleet_health(run_log: DataFrame, quarantine: DataFrame, expected: DataFrame, *, as_of, limits: dict | None = None, formats: DataFrame | None = None) -> DataFrame:
    """(silver_name, check, detail): findings over the run log, each check one query.

    Missing runs, streaks of empty runs, stale tables, low parse rates, jumps in fields, notes of type conflicts, rebuild storms, quarantine
    floods, shifts of the rung mix against seven days, mixed time formats (``formats``: silver_name, format), and field budgets.
    """
    lim = LIMITS | (limits or {})
    now = F.lit(str(as_of)).cast("timestamp")
    log = run_log.where(F.col("logged_at") <= now)
    today = log.where(F.to_date("logged_at") == F.to_date(now))

    def finding(df, check, detail):
        return df.select("silver_name", F.lit(check).alias("check"), detail.cast("string").alias("detail"))

    per = Window.partitionBy("silver_name").orderBy("logged_at")
    newest = Window.partitionBy("silver_name").orderBy(F.col("logged_at").desc())
    empty = log.withColumn("run", F.sum(F.when(F.col("cdc_rows") > 0, 1).otherwise(0)).over(newest.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    streak = empty.where("run = 0").groupBy("silver_name").agg(F.count("*").alias("n")).where(F.col("n") >= lim["empty_streak"])
    last = log.groupBy("silver_name").agg(F.max("logged_at").alias("at"))
    hours = (now.cast("long") - F.col("at").cast("long")) / 3600
    rate = today.withColumn("rate", F.col("parsed_valid") / F.nullif(F.col("parsed_valid") + F.col("parsed_null"), F.lit(0)))
    jump = log.withColumn("before", F.lag("fields_discovered").over(per)).where(F.to_date("logged_at") == F.to_date(now)).where(F.abs(F.col("fields_discovered") - F.col("before")) > lim["field_jump"])
    storm = log.where((F.col("mode") == "rebuild") & (F.col("logged_at") > now - F.make_dt_interval(F.lit(lim["rebuild_days"])))).groupBy("silver_name").agg(F.count("*").alias("n")).where(F.col("n") > lim["rebuilds"])
    flood = quarantine.where(F.to_date("quarantined_at") == F.to_date(now)).groupBy("silver_name").agg(F.count("*").alias("n")).where(F.col("n") > lim["quarantine_day"])
    mix = log.where("rung_stats IS NOT NULL").select("silver_name", "logged_at", F.explode(F.from_json("rung_stats", "map<string,bigint>")).alias("rung", "n"))
    pct = lambda d: d.groupBy("silver_name", "rung").agg(F.sum("n").alias("n")).withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("silver_name")))
    base = pct(mix.where((F.to_date("logged_at") < F.to_date(now)) & (F.to_date("logged_at") >= F.date_sub(F.to_date(now), 7)))).select("silver_name", "rung", F.col("pct").alias("base"))
    shift = pct(mix.where(F.to_date("logged_at") == F.to_date(now))).join(base, ["silver_name", "rung"], "full_outer").withColumn("d", F.round(F.abs(F.coalesce("pct", F.lit(0.0)) - F.coalesce("base", F.lit(0.0))), 1))
    both = shift.join(base.select("silver_name").distinct(), "silver_name", "left_semi").join(today.select("silver_name").distinct(), "silver_name", "left_semi")
    parts = [
        finding(expected.join(today.select("silver_name").distinct(), "silver_name", "left_anti"), "missing run", F.lit("no run today")),
        finding(streak, "empty streak", F.col("n")),
        finding(last.where(hours > lim["stale_hours"]), "stale", F.round(hours, 1)),
        finding(rate.where(F.col("rate") < lim["parse_rate"]), "parse rate", F.round("rate", 3)),
        finding(jump, "field jump", F.concat_ws(" to ", "before", "fields_discovered")),
        finding(today.where(F.lower("note").contains("type conflict")), "type conflict", F.col("note")),
        finding(storm, "rebuild storm", F.col("n")),
        finding(flood, "quarantine flood", F.col("n")),
        finding(both.where(F.col("d") > lim["rung_shift"]), "rung shift", F.concat_ws(": ", F.coalesce("rung", F.lit("none")), "d")),
        finding(field_budget(log, lim["fields"]), "field budget", F.col("fields")),
    ]
    if formats is not None:
        parts.append(finding(formats.groupBy("silver_name").agg(F.count_distinct("format").alias("n")).where("n > 1"), "time format", F.col("n")))
    return _union(parts)
