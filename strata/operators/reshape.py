"""Flattening, exploding, maps and pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sanitize_name(name: str) -> str:
    import re

    return re.sub(r"\W", "_", name, flags=re.ASCII)


def dedup_names(names: Sequence[str]) -> list[str]:
    """Names that differ in any case: a repeat gets _2, _3, ..."""
    seen: set[str] = set()
    out = []
    for n in names:
        k, new = 1, n
        while new.lower() in seen:
            k += 1
            new = f"{n}_{k}"
        seen.add(new.lower())
        out.append(new)
    return out


def sanitize_names(df: DataFrame) -> DataFrame:
    """Columns named by [A-Za-z0-9_] only, all different in any case."""
    return df.toDF(*dedup_names([sanitize_name(c) for c in df.columns]))


def flatten_structs(df: DataFrame, *, skip: Sequence[str] = (), passes: int = 10) -> DataFrame:
    """Structs become columns <parent>_<field> until none are left; ``skip`` stays nested."""
    for _ in range(passes):
        structs = [f.name for f in df.schema if isinstance(f.dataType, T.StructType) and f.name not in skip]
        if not structs:
            return df
        cols, names = [], []
        for f in df.schema:
            if f.name in structs:
                cols += [F.col(f"`{f.name}`.`{x.name}`") for x in f.dataType]
                names += [f"{f.name}_{x.name}" for x in f.dataType]
            else:
                cols.append(F.col(f"`{f.name}`"))
                names.append(f.name)
        df = df.select(*[c.alias(n) for c, n in zip(cols, dedup_names(names), strict=True)])
    return df


def explode_to_child(df: DataFrame, array_col: str, parent: str, key: str, *, carry: Sequence[str] = (), position: str | None = None) -> DataFrame:
    """A row for each non-null element: <parent>_<key>, carried columns, and the element's fields (or ``value``).

    Element fields that clash with the key or a carried column get the prefix <array>_.
    """
    kind = df.schema[array_col].dataType.elementType
    rows = df.select(F.col(key).alias(f"{parent}_{key}"), *carry, F.posexplode(array_col).alias("__pos", "__el")).where("__el IS NOT NULL")
    taken = {f"{parent}_{key}".lower(), *(c.lower() for c in carry)}
    if isinstance(kind, T.StructType):
        fields = [F.col(f"__el.`{f.name}`").alias(f.name if f.name.lower() not in taken else f"{array_col}_{f.name}") for f in kind]
    else:
        fields = [F.col("__el").alias("value")]
    at = [F.col("__pos").alias(position)] if position else []
    return rows.select(f"{parent}_{key}", *carry, *at, *fields)


def derived_columns(df: DataFrame, *, renamed: dict[str, str] | None = None, first_of: dict[str, Sequence[str]] | None = None, joined: dict[str, tuple[str, Sequence[str]]] | None = None, cases: dict[str, Sequence[tuple[Column, object]]] | None = None) -> DataFrame:
    """``df`` with columns by rule, all computed from its own columns in one projection; a name that is there already is replaced.

    renamed: {new: old}, the old one goes. first_of: {new: columns}, the first value that is neither null nor blank text. joined: {new: (separator,
    columns)}, those values joined, null without any. cases: {new: (condition, value) pairs}, the first that holds, else null; values are columns or literals.
    """
    def known(c: str) -> Column:
        value = F.col(f"`{c}`")
        return F.when(F.trim(value) != "", value) if isinstance(df.schema[c].dataType, T.StringType) else value

    new = {n: F.col(f"`{old}`") for n, old in (renamed or {}).items()}
    new |= {n: F.coalesce(*map(known, cs)) for n, cs in (first_of or {}).items()}
    new |= {n: F.nullif(F.concat_ws(sep, *[known(c).cast("string") for c in cs]), F.lit("")) for n, (sep, cs) in (joined or {}).items()}
    new |= {n: F.coalesce(*[F.when(w, v if isinstance(v, Column) else F.lit(v)) for w, v in pairs]) for n, pairs in (cases or {}).items()}
    gone = {n.lower() for n in new} | {old.lower() for old in (renamed or {}).values()}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone], *[c.alias(n) for n, c in new.items()])


def explode_children(df: DataFrame, array_col: str, parent: str, key: str, *, depth: int = 3) -> dict[str, DataFrame]:
    """{name: child}: explode_to_child, and so on through arrays of structs that have the key's field ``id``."""
    child = explode_to_child(df, array_col, parent, key)
    name = f"{parent}_{array_col}"
    out = {name: child}
    if depth > 1 and "id" in child.columns:
        for f in child.schema:
            if isinstance(f.dataType, T.ArrayType):
                out |= explode_children(child, f.name, name, "id", depth=depth - 1)
    return out


def explode_rows(df: DataFrame, array_col: str, *, carry: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Outer explode and the element's fields; rows whose fields are all null go."""
    rows = df.select(*carry, F.explode_outer(array_col).alias("__el")).select(*carry, *[F.col(f"__el.`{x}`") for x in fields])
    return rows.dropna(how="all", subset=list(fields))


def explode_fragments(df: DataFrame, array_col: str, *, carry: Sequence[str], field: str, where: Column | None = None) -> DataFrame:
    """(carry, pos, text) of the non-null text fragments."""
    df = df if where is None else df.where(where)
    rows = df.select(*carry, F.posexplode(array_col).alias("pos", "__el"))
    return rows.select(*carry, "pos", F.col(f"__el.`{field}`").alias("text")).where("text IS NOT NULL")


def element_text(element: Column, kind: T.DataType, fields: Sequence[str]) -> Column:
    """An element as a struct of ``fields``, whether it is a struct, JSON text, ``{a, b}`` text or bare text (the first field)."""
    if isinstance(kind, T.StructType):
        have = {f.name for f in kind}
        return F.struct(*[(element[x].cast("string") if x in have else F.lit(None).cast("string")).alias(x) for x in fields])
    parsed = F.from_json(element, T.StructType([T.StructField(x, T.StringType()) for x in fields]))
    listed = F.split(F.regexp_extract(element, r"^\s*\{([^:{}]*)\}\s*$", 1), r"\s*,\s*")
    by_place = F.struct(*[F.nullif(F.trim(F.try_element_at(listed, F.lit(i + 1))), F.lit("")).alias(x) for i, x in enumerate(fields)])
    bare = F.struct(*[(F.trim(element) if i == 0 else F.lit(None).cast("string")).alias(x) for i, x in enumerate(fields)])
    return F.when(F.try_parse_json(element).isNotNull() & element.rlike(r"^\s*\{"), parsed).when(element.rlike(r"^\s*\{[^:{}]*\}\s*$"), by_place).otherwise(bare)


def unpivot_arrays(df: DataFrame, arrays: Sequence[str], *, carry: Sequence[str], fields: Sequence[str] = ("name", "email"), prefix: str = "") -> DataFrame:
    """(carry, direction, fields): the elements of several arrays, named by their array; all-null elements go."""
    parts = []
    for a in arrays:
        kind = df.select(F.col(f"{prefix}{a}")).schema[0].dataType.elementType
        rows = df.select(*carry, F.lit(a).alias("direction"), F.explode(F.col(f"{prefix}{a}")).alias("__el"))
        parts.append(rows.select(*carry, "direction", element_text(F.col("__el"), kind, fields).alias("e")).select(*carry, "direction", "e.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.dropna(how="all", subset=list(fields))


def extract_map(df: DataFrame, *, prefix: str = "cf_", struct_col: str | None = None, name: str = "custom_fields") -> DataFrame:
    """Fields that start with ``prefix`` (of the struct, or of the table) as one MAP<STRING, STRING>; nulls left out, nested values as JSON text."""
    fields = df.schema[struct_col].dataType if struct_col else df.schema
    chosen = [f for f in fields if f.name.lower().startswith(prefix)]

    def text(f):
        c = F.col(f"`{struct_col}`.`{f.name}`" if struct_col else f"`{f.name}`")
        return F.to_json(c) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else c.cast("string")

    entries = F.array(*[F.struct(F.lit(f.name).alias("key"), text(f).alias("value")) for f in chosen]) if chosen else F.array().cast("array<struct<key:string,value:string>>")
    out = df.withColumn(name, F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())))
    return out if struct_col else out.drop(*[f.name for f in chosen])


#: Most keys that become columns.
MOST_KEYS = 2000


def map_keys_of(df: DataFrame, map_col: str, *, most: int = MOST_KEYS) -> list[str]:
    """All keys of the whole table, sorted; a map with more than ``most`` holds data in its keys, and raises: map_to_rows takes those."""
    keys = [r[0] for r in df.select(F.explode(F.map_keys(map_col)).alias("k")).distinct().limit(most + 1).collect()]
    if len(keys) > most:
        raise ValueError(f"{map_col} has more than {most} keys")
    return sorted(keys)


def pivot_map(df: DataFrame, map_col: str, *, keys_from: DataFrame | None = None, carry: Sequence[str] | None = None) -> DataFrame:
    """One column for each key that the whole of ``keys_from`` has."""
    keys = map_keys_of(keys_from if keys_from is not None else df, map_col)
    keep = list(carry) if carry is not None else [c for c in df.columns if c != map_col]
    names = dedup_names([*keep, *map(sanitize_name, keys)])[len(keep):]
    return df.select(*keep, *[F.try_element_at(map_col, F.lit(k)).alias(n) for k, n in zip(keys, names, strict=True)])


def map_to_rows(df: DataFrame, map_col: str, defs: DataFrame | None = None, on: Sequence[str] = (), *, carry: Sequence[str] = ()) -> DataFrame:
    """(carry, key, value) of non-null entries, with definitions found on all of ``on``; definitions must be unique there."""
    from strata.operators.joins import enrich_left

    rows = df.select(*carry, F.explode(map_col).alias("key", "value")).where("value IS NOT NULL")
    return rows if defs is None else enrich_left(rows, defs, list(on))


def conditional_pivot(df: DataFrame, by: str, tag_col: str, value_col: str, tags: Sequence[str]) -> DataFrame:
    """One sorted array of distinct values for each tag, in a row for each ``by``."""
    return df.groupBy(by).agg(*[F.array_sort(F.collect_set(F.when(F.col(tag_col) == t, F.col(value_col)))).alias(sanitize_name(str(t))) for t in tags])
