"""Schema discovery from JSON payloads, grow-only union, casts and drift."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.reshape import dedup_names, sanitize_name


def _from_variant(text: str) -> T.DataType:
    """Spark's text of a variant schema as a type: OBJECT to struct, VOID and VARIANT to string."""
    ddl = text.replace("OBJECT<", "STRUCT<")
    return _settle(T.DataType.fromDDL(ddl)) if not ddl.startswith("STRUCT<>") else T.StructType()


def _settle(t: T.DataType) -> T.DataType:
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _settle(f.dataType)) for f in t])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_settle(t.elementType))
    if isinstance(t, (T.NullType, T.VariantType)):
        return T.StringType()
    if isinstance(t, T.DecimalType):
        return T.DoubleType()
    return t


def discover_schema(df: DataFrame, col: str, *, sample: float | None = None, seed: int = 42) -> T.DataType:
    """The merged type of all payloads that parse: an aggregate over every row, or over a seeded share of them."""
    df = df if sample is None else df.sample(fraction=sample, seed=seed)
    text = df.select(F.schema_of_variant_agg(F.try_parse_json(F.col(col))).alias("s")).first()["s"]
    return T.StructType() if text in (None, "VOID", "VARIANT") else _from_variant(text)


def top_level_shape(df: DataFrame, col: str) -> str:
    """``object``, ``array`` or ``scalar``, by the majority of parsed payloads; ties in that order."""
    v = F.schema_of_variant(F.try_parse_json(F.col(col)))
    shape = F.when(v.startswith("OBJECT"), "object").when(v.startswith("ARRAY"), "array").when(v.isNotNull(), "scalar")
    counts = {r["shape"]: r["count"] for r in df.select(shape.alias("shape")).where("shape IS NOT NULL").groupBy("shape").count().collect()}
    return max(("object", "array", "scalar"), key=lambda s: counts.get(s, 0))


def variant_schema_to_struct(text: str) -> T.DataType:
    """A type from a variant schema's text, with safe field names that differ in any case."""
    def safe(t):
        if isinstance(t, T.StructType):
            names = dedup_names([sanitize_name(f.name) for f in t])
            return T.StructType([T.StructField(n, safe(f.dataType)) for n, f in zip(names, t, strict=True)])
        return T.ArrayType(safe(t.elementType)) if isinstance(t, T.ArrayType) else t

    return safe(_from_variant(text))


def descend_degraded(df: DataFrame, col: str, *, levels: int = 3) -> T.DataType:
    """discover_schema, and where arrays come out as text, once more over their elements, down to ``levels``."""
    found = discover_schema(df, col)
    payload = F.try_parse_json(F.col(col))
    for level in range(levels):
        if not (isinstance(found, T.ArrayType) and isinstance(found.elementType, T.StringType)):
            return found
        v = df.select(payload.alias("v")).where("v IS NOT NULL")
        for _ in range(level + 1):
            v = v.select(F.explode(F.try_variant_get("v", "$", "array<variant>")).alias("v"))
        text = v.select(F.schema_of_variant_agg("v").alias("s")).first()["s"]
        if text not in (None, "VOID", "VARIANT"):
            return T.ArrayType(_from_variant(text))
    raise ValueError(f"no element type within {levels} levels")


def registry_union(schema: T.StructType, registry: DataFrame, table: str) -> T.StructType:
    """The discovered fields, then those the registry remembers for the table; a known name, raw or sanitised, isn't added twice."""
    have = {n.lower() for f in schema for n in (f.name, sanitize_name(f.name))}
    out = list(schema)
    for r in registry.where(F.col("silver_name") == table).select("field_name", "ddl_type").distinct().orderBy("field_name").collect():
        if not {r["field_name"].lower(), sanitize_name(r["field_name"]).lower()} & have:
            have |= {r["field_name"].lower(), sanitize_name(r["field_name"]).lower()}
            out.append(T.StructField(r["field_name"], T.DataType.fromDDL(r["ddl_type"])))
    return T.StructType(out)


def registry_rows(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """(silver_name, field_name, ddl_type) of a schema's fields."""
    return spark.createDataFrame([(table, f.name, f.dataType.simpleString()) for f in schema], "silver_name string, field_name string, ddl_type string")


def parse_payload(df: DataFrame, col: str, schema: T.DataType, *, out: str = "parsed") -> DataFrame:
    """``df`` with the payload parsed to the type; null where it doesn't parse."""
    ok = F.try_parse_json(F.col(col)).isNotNull()
    return df.withColumn(out, F.when(ok, F.from_json(F.col(col), schema)))


def explode_payload(df: DataFrame, *, col: str = "parsed") -> DataFrame:
    """An object's fields, or each array element's, as columns beside the others; scalars as ``value``."""
    kind = df.schema[col].dataType
    keep = [F.col(f"`{c}`") for c in df.columns if c != col]
    if isinstance(kind, T.ArrayType):
        df, kind = df.select(*keep, F.explode_outer(col).alias(col)), kind.elementType
    fields = [F.col(f"{col}.`{f.name}`") for f in kind] if isinstance(kind, T.StructType) else [F.col(col).alias("value")]
    names = dedup_names([*(c for c in df.columns if c != col), *(f.name for f in kind)] if isinstance(kind, T.StructType) else [*(c for c in df.columns if c != col), "value"])
    return df.select(*keep, *fields).toDF(*names)


def sentinel_nulls(df: DataFrame, values: Sequence[str]) -> DataFrame:
    """Placeholder texts, in any case and with blanks around, become null in all string columns."""
    low = [v.lower() for v in values]
    clean = lambda c: F.when(~F.lower(F.trim(c)).isin(low) | c.isNull(), c)
    return df.select(*[clean(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema])


def classify_columns(schema: T.StructType) -> dict[str, list[str]]:
    """Names by kind: scalars, arrays, structs, maps."""
    out: dict[str, list[str]] = {"scalars": [], "arrays": [], "structs": [], "maps": []}
    for f in schema:
        out["arrays" if isinstance(f.dataType, T.ArrayType) else "structs" if isinstance(f.dataType, T.StructType) else "maps" if isinstance(f.dataType, T.MapType) else "scalars"].append(f.name)
    return out


def cast_tree(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """``c`` as the target type: structs by field name (missing null, extra dropped), arrays by element, text to nested through JSON, nested to text as JSON, nested to other scalars null."""
    if source == target:
        return c
    nested = (T.StructType, T.ArrayType, T.MapType)
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        have = {f.name.lower(): f for f in source}
        fields = [cast_tree(c[have[f.name.lower()].name], have[f.name.lower()].dataType, f.dataType).alias(f.name) if f.name.lower() in have else F.lit(None).cast(f.dataType).alias(f.name) for f in target]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.transform(c, lambda x: cast_tree(x, source.elementType, target.elementType))
    if isinstance(target, nested):
        return F.from_json(c, target) if isinstance(source, T.StringType) else F.lit(None).cast(target)
    if isinstance(source, nested):
        return F.to_json(c) if isinstance(target, T.StringType) else F.lit(None).cast(target)
    return c.try_cast(target)


def reconcile_to_target(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns that the target has get its type; new ones stay; names that clash in case raise."""
    low = [c.lower() for c in df.columns]
    if len(set(low)) != len(low):
        raise ValueError("columns that differ in case only")
    want = {f.name.lower(): f for f in schema}
    cols = []
    for f in df.schema:
        t = want.get(f.name.lower())
        cols.append(cast_tree(F.col(f"`{f.name}`"), f.dataType, t.dataType).alias(t.name) if t else F.col(f"`{f.name}`"))
    return df.select(*cols)


def add_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the target's other columns as nulls."""
    have = {c.lower() for c in df.columns}
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema if f.name.lower() not in have})


def column_drop_guard(old: T.StructType, new: T.StructType, allow: Sequence[str] = ()) -> None:
    """Raise when an overwrite would lose columns that aren't allow-listed."""
    lost = {f.name.lower() for f in old} - {f.name.lower() for f in new} - {a.lower() for a in allow}
    if lost:
        raise ValueError(f"columns would be lost: {sorted(lost)}")


def _walk(t: T.DataType, path: str):
    if isinstance(t, T.StructType):
        for f in t:
            at = f"{path}.{f.name}" if path else f.name
            yield at, f.dataType.simpleString(), "array" if isinstance(f.dataType, T.ArrayType) else "struct" if isinstance(f.dataType, T.StructType) else "map" if isinstance(f.dataType, T.MapType) else "scalar"
            yield from _walk(f.dataType, at)
    elif isinstance(t, T.ArrayType):
        yield from _walk(t.elementType, f"{path}[]")


def schema_paths(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """(path, type, kind, child_table) of every nested field; an array of structs may become a child table."""
    rows = [(p, t, k, bool(re.match(r"array<struct", t))) for p, t, k in _walk(schema, "")]
    return spark.createDataFrame(rows, "path string, type string, kind string, child_table boolean")


def nested_drift(spark: SparkSession, old: T.StructType, new: T.StructType) -> DataFrame:
    """(path, change, old_type, new_type): paths dropped, added or retyped."""
    a = schema_paths(spark, old).select("path", F.col("type").alias("old_type"))
    b = schema_paths(spark, new).select("path", F.col("type").alias("new_type"))
    change = F.when(F.col("new_type").isNull(), "dropped").when(F.col("old_type").isNull(), "added").when(F.col("old_type") != F.col("new_type"), "retyped")
    return a.join(b, "path", "full_outer").select("path", change.alias("change"), "old_type", "new_type").where("change IS NOT NULL")


def registry_audit(spark: SparkSession, registry: DataFrame, schemas: dict[str, T.StructType]) -> DataFrame:
    """(silver_name, field_name, problem): registered fields no table has, and columns nobody registered."""
    rows = [(t, f.name) for t, s in schemas.items() for f in s]
    have = spark.createDataFrame(rows, "silver_name string, field_name string")
    known = registry.select("silver_name", "field_name").distinct()
    on = ["silver_name", "field_name"]
    return known.join(have, on, "left_anti").withColumn("problem", F.lit("orphan")).unionByName(have.join(known, on, "left_anti").withColumn("problem", F.lit("unregistered")))
