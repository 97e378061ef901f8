"""Writes as functions of (target, batch): upserts, replacements and quarantines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.dedup import latest_per_key
from strata.operators.schema import add_missing_columns, column_drop_guard, reconcile_to_target


def upsert_by_key(target: DataFrame, batch: DataFrame, key: str, *, event_time: str | None = None, load_time: str = "bronze_updated_at", first_seen: str = "bronze_insert_date") -> DataFrame:
    """The target after the batch: one row a key, in one full outer join.

    The batch is cut to its latest row a key and cast to the target's types. A matched row is replaced when the batch is newer on the clock (event
    time if given, else load time) or the target has no clock; its first-seen date stays, and so do columns the batch
    hasn't. New keys are added, new columns too. Rows of the batch with a null key must have gone to quarantine before.
    """
    clock = event_time or load_time
    if key not in batch.columns:
        raise ValueError(f"the batch has no key column {key}")
    order = [F.col(clock).desc_nulls_last(), *([F.col(load_time).desc_nulls_last()] if load_time in batch.columns and load_time != clock else []), F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in batch.columns]).desc()]
    one = latest_per_key(batch.where(F.col(key).isNotNull()), [key], order, keep_null_keys=False)
    one = reconcile_to_target(one, target.schema)
    own = {c.lower() for c in one.columns}
    t, s = add_missing_columns(target, one.schema), add_missing_columns(one, target.schema)
    names = t.columns
    # the keys beside the rows, as columns: a target that is bucketed by key then needs no shuffle
    t, s = (x.select(F.col(f"`{key}`").alias(f"{n}_key"), F.struct(*[F.col(f"`{c}`") for c in names]).alias(n)) for x, n in ((t, "t"), (s, "s")))
    both = t.join(s, F.col("t_key") == F.col("s_key"), "full_outer")
    newer = F.col("t").isNull() | (F.col("s").isNotNull() & (F.col(f"t.`{clock}`").isNull() | (F.col(f"s.`{clock}`") > F.col(f"t.`{clock}`"))))
    newer = F.coalesce(newer, F.lit(False))

    def pick(c):
        mine, theirs = F.col(f"t.`{c}`"), F.col(f"s.`{c}`")
        if c.lower() not in own:
            return mine.alias(c)
        if c == first_seen:
            return F.when(F.col("t").isNull(), theirs).otherwise(F.coalesce(mine, theirs)).alias(c)
        return F.when(newer, theirs).otherwise(mine).alias(c)

    return both.select(*[pick(c) for c in names])


#: Column of a keyed table that says in which part, and bucket, a key lies.
PART = "key_part"


def create_keyed(df: DataFrame, name: str, key: str, *, parts: int | None = None) -> None:
    """Write a managed table for upsert_keyed: partitioned by the hash of its key, and bucketed by it into as many, so a part is one file.

    ``df`` has one row a key (latest_per_key sees to that). ``parts`` stays for good; it should be the number of shuffle partitions or more, which is the default.
    """
    if df.where(F.col(f"`{key}`").isNull()).limit(1).count():
        raise ValueError(f"rows without {key} belong in quarantine")
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.withColumn(PART, F.pmod(F.hash(F.col(f"`{key}`")), F.lit(n))).repartition(n, F.col(f"`{key}`"))
    rows.write.partitionBy(PART).bucketBy(n, key).saveAsTable(name)


def keyed_parts(spark: SparkSession, name: str) -> int:
    """In how many parts a keyed table lies."""
    return int(spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").first()["data_type"])


def keyed_rows(spark: SparkSession, name: str) -> DataFrame:
    """A keyed table's rows without the column of parts."""
    return spark.table(name).drop(PART)


def upsert_keyed(spark: SparkSession, name: str, batch: DataFrame, key: str, **kw) -> list[int]:
    """upsert_by_key on a table of create_keyed, which rewrites only the parts that hold a key of the batch; returns those parts.

    The scan reads those parts alone, and only the batch is shuffled: the table's buckets are partitioned by key already. New columns of the batch are
    added to the table; parts that aren't touched read as null there. The parts are swapped when the job commits, so a job that fails leaves the table as it
    was, and applying a batch twice changes nothing. One writer at a time. Null keys must have gone to quarantine before; an empty batch touches nothing.
    """
    n, table = keyed_parts(spark, name), spark.table(name)
    kind = table.schema[key].dataType
    batch = batch.where(F.col(f"`{key}`").isNotNull())
    part = F.pmod(F.hash(F.col(f"`{key}`").try_cast(kind)), F.lit(n))
    touched = sorted(r[0] for r in batch.select(part.alias("p")).distinct().collect())  # at most n
    if not touched:
        return []
    old = table.where(F.col(PART).isin(touched)).drop(PART)
    out = upsert_by_key(old, batch, key, **kw)
    if added := [f for f in out.schema if f.name.lower() not in {c.lower() for c in table.columns}]:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in added)})")
    out = out.withColumn(PART, F.pmod(F.hash(F.col(f"`{key}`")), F.lit(n))).select(spark.table(name).columns)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        out.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)
    spark.catalog.refreshTable(name)
    return touched


def window_replace(target: DataFrame, batch: DataFrame, ts_col: str, watermark) -> DataFrame:
    """The target without rows after the watermark, and the batch."""
    kept = target if watermark is None else target.where(F.col(ts_col).isNull() | (F.col(ts_col) <= F.lit(watermark)))
    return kept.unionByName(batch, allowMissingColumns=True)


def replace_affected_keys(target: DataFrame, batch: DataFrame, key: str, changed: DataFrame) -> DataFrame:
    """All rows of changed parents go, the batch's come; a parent with no rows now has none."""
    return target.join(changed.select(key).distinct(), key, "left_anti").unionByName(batch, allowMissingColumns=True)


def replace_table(spark: SparkSession, name: str, df: DataFrame, *, allow_drop: Sequence[str] = ()) -> None:
    """Swap a managed table for ``df``, which may read it: written beside it, then renamed. Lost columns raise.

    The old table is renamed away first and dropped last, so its rows are never without a name: a run that finds ``<name>__old`` and
    no ``<name>`` puts it back before anything else.
    """
    beside, old = f"{name}__next", f"{name}__old"
    restore_table(spark, name)
    if exists := spark.catalog.tableExists(name):
        column_drop_guard(spark.table(name).schema, df.schema, allow_drop)
    df.write.mode("overwrite").saveAsTable(beside)
    if exists:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {beside} RENAME TO {name}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def restore_table(spark: SparkSession, name: str) -> None:
    """Put the old table back if a swap has ended between its renames."""
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(f"{name}__old"):
        spark.sql(f"ALTER TABLE {name}__old RENAME TO {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a managed table with its rows."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def table_sink(df: DataFrame, name: str, *, mode: str = "append", partition_by: Sequence[str] = ()) -> None:
    """Append to or overwrite a managed Parquet table; an append may bring new columns."""
    spark = df.sparkSession
    if mode == "append" and spark.catalog.tableExists(name):
        old = spark.table(name)
        if {c.lower() for c in df.columns} - {c.lower() for c in old.columns}:
            replace_table(spark, name, old.unionByName(df, allowMissingColumns=True))
            return
        df = add_missing_columns(df, old.schema).select(old.columns)
    df.write.mode(mode).partitionBy(*partition_by).saveAsTable(name)


def nested_types_differ(old: T.StructType, new: T.StructType) -> bool:
    """Whether a struct, array or map that both have is of another type, whatever may be null in it."""
    plain = lambda t: t.simpleString().lower()
    nested = (T.StructType, T.ArrayType, T.MapType)
    have = {f.name.lower(): f.dataType for f in old}
    return any(plain(have[f.name.lower()]) != plain(f.dataType) for f in new if f.name.lower() in have and isinstance(f.dataType, nested) and isinstance(have[f.name.lower()], nested))


def write_route(target: DataFrame | None, batch: DataFrame, *, key: str | None = None, watermark=None, ts_col: str = "bronze_updated_at", **kw) -> tuple[str, DataFrame]:
    """(route, result): ``upsert`` with a key, else ``window`` with a watermark, else ``full``.

    A declared key the batch hasn't got raises. Where a nested column of the batch has other fields or elements than the target's, casting would lose
    them: the route is ``rebuild`` and the result the batch alone, for the caller to feed with the full history.
    """
    if key and key not in batch.columns:
        raise ValueError(f"the batch has no key column {key}")
    if target is None:
        return "full", batch
    if nested_types_differ(target.schema, batch.schema):
        column_drop_guard(target.schema, batch.schema)
        return "rebuild", batch
    if key:
        return "upsert", upsert_by_key(target, batch, key, **kw)
    if watermark is not None:
        return "window", window_replace(target, batch, ts_col, watermark)
    column_drop_guard(target.schema, batch.schema)
    return "full", batch


def _new_rows(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = F.lit(True)
    k = known.select(*[F.col(c).alias(f"__{c}") for c in keys]).distinct()
    for c in keys:
        cond &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    return rows.dropDuplicates(list(keys)).join(k, cond, "left_anti")


def parse_quarantine(df: DataFrame, quarantine: DataFrame, *, parsed: str = "parsed", hash_col: str = "payload_hash") -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, quarantine rows to add): unparsed rows, each hash once, unless the quarantine holds it."""
    bad = df.where(F.col(parsed).isNull())
    add = _new_rows(bad, quarantine, [hash_col])
    return df.where(F.col(parsed).isNotNull()), add.select(*[c for c in df.columns if c != parsed])


def null_key_quarantine(df: DataFrame, quarantine: DataFrame, key: str, *, table: str, dedup_on: Sequence[str] = ("table_name", "pk_column", "payload_hash", "row_json")) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, quarantine rows to add): null-key rows as JSON, equal ones once, unless already held."""
    bad = df.where(F.col(key).isNull())
    hash_col = F.col("payload_hash") if "payload_hash" in df.columns else F.lit(None).cast("string")
    rows = bad.select(F.lit(table).alias("table_name"), F.lit(key).alias("pk_column"), hash_col.alias("payload_hash"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row_json"))
    return df.where(F.col(key).isNotNull()), _new_rows(rows, quarantine, list(dedup_on))


def contract_checks(df: DataFrame, *, not_null: Sequence[str] = (), unique: Sequence[Sequence[str]] = (), checks: dict[str, Column] | None = None) -> DataFrame:
    """(rule, violations): rows that break each rule, counted in one pass, and one aggregate for each unique key."""
    tests = {f"not null: {c}": F.col(c).isNull() for c in not_null} | {f"check: {n}": ~F.coalesce(e, F.lit(True)) for n, e in (checks or {}).items()}
    parts = []
    if tests:
        one = df.agg(*[F.count_if(t).alias(f"v{i}") for i, t in enumerate(tests.values())])
        parts.append(one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"v{i}").alias("violations")) for i, n in enumerate(tests)])).alias("r")).select("r.*"))
    for keys in unique:
        dup = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
        parts.append(dup.select(F.lit(f"unique: {', '.join(keys)}").alias("rule"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
