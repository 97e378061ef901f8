"""Schema discovery that is kept: one small table of paths and types, folded from batch to batch, from which schemas and drift follow.

A state has a row for each (path, type): n payloads with it, first_day and last_day. ``a.b[].c`` is field c of the items of list b; the path of the
payload itself is empty. Payloads are first grouped by their schema's text, so what is walked are distinct shapes, not rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.schema import discover_schema

STATE = "path string, type string, n bigint, first_day date, last_day date"
#: Type of a payload that isn't JSON.
UNPARSED = "UNPARSED"
_TOKENS = re.compile(r"`(?:[^`]|``)*`|[<>,:]|[^\s<>,:`(]+(?:\([^)]*\))?")


def _step(name: str) -> str:
    """A field's name as a step of a path, quoted where it has a character that means something there."""
    return f"`{name.replace('`', '``')}`" if re.search(r"[.\[\]`]", name) or not name else name


def paths_of(shape: str) -> list[tuple[str, str]]:
    """(path, type) of all that a variant schema's text names; OBJECT and ARRAY for what holds others, DOUBLE for decimals."""
    tokens, out, stack, i = _TOKENS.findall(shape), [], [], 0
    path = ""
    while i < len(tokens):
        kind = tokens[i]
        out.append((path, "DOUBLE" if kind.startswith("DECIMAL") else kind))
        i += 1
        if kind in ("OBJECT", "ARRAY") and i < len(tokens) and tokens[i] == "<":
            stack.append((kind, path))
            i += 1
        while stack and i < len(tokens) and tokens[i] == ">":
            stack.pop()
            i += 1
        if not stack or i >= len(tokens):
            break
        kind, above = stack[-1]
        i += tokens[i] == ","
        if kind == "ARRAY":
            path = above + "[]"
        else:
            name = tokens[i]
            name = name[1:-1].replace("``", "`") if name.startswith("`") else name
            path = f"{above}.{_step(name)}" if above else _step(name)
            i += 2  # the name and its colon
    return out


def _walked(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for b in batches:
        rows = [(path, kind, n, day) for shape, n, day in zip(*(b[c].to_pylist() for c in ("shape", "n", "day")), strict=True) for path, kind in (paths_of(shape) if shape else [("", UNPARSED)])]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.date32()))], names=["path", "type", "n", "day"])


def path_state(df: DataFrame, col: str, day: Column | str) -> DataFrame:
    """The state of the payloads in ``df``. Null payloads count as unparsed; a null day leaves first_day and last_day to the others."""
    shape = F.schema_of_variant(F.try_parse_json(F.col(col)))
    shapes = df.select(shape.alias("shape"), (F.col(day) if isinstance(day, str) else day).cast("date").alias("day")).groupBy("shape", "day").agg(F.count("*").alias("n"))
    rows = shapes.mapInArrow(_walked, "path string, type string, n bigint, day date")
    return rows.groupBy("path", "type").agg(F.sum("n").alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def fold_state(state: DataFrame, batch: DataFrame) -> DataFrame:
    """Two states as one: the same, in any order and grouping, as the state of all their payloads."""
    both = state.unionByName(batch)
    return both.groupBy("path", "type").agg(F.sum("n").alias("n"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))


def _split(path: str) -> list[str]:
    return re.findall(r"`(?:[^`]|``)*`|\[\]|[^.\[\]`]+", path)


def state_schema(state: DataFrame) -> T.DataType:
    """The type of all payloads of the state, as discover_schema finds it: no payload is read again.

    Whole numbers and decimals together are doubles; kinds that don't go together are text, with all below them. The state's distinct paths
    come to the driver, as any schema does.
    """
    kinds: dict[tuple, set] = {}
    for r in state.where(F.col("type") != UNPARSED).select("path", "type").distinct().toLocalIterator():
        kinds.setdefault(tuple(_split(r["path"])), set()).add(r["type"])
    below: dict[tuple, set] = {}
    for at in kinds:
        if at:
            below.setdefault(at[:-1], set()).add(at[-1])

    def of(at: tuple) -> T.DataType:
        found = kinds.get(at, set()) - {"VOID"}
        if found == {"OBJECT"}:
            names = sorted((s[1:-1].replace("``", "`") if s.startswith("`") else s, s) for s in below.get(at, ()) if s != "[]")
            return T.StructType([T.StructField(name, of((*at, s))) for name, s in names])
        if found == {"ARRAY"}:
            return T.ArrayType(of((*at, "[]")))
        if found <= {"BIGINT", "DOUBLE"} and found:
            return T.DoubleType() if "DOUBLE" in found else T.LongType()
        return {("BOOLEAN",): T.BooleanType()}.get(tuple(found), T.StringType())

    return of(()) if kinds.get((), set()) - {"VOID"} else T.StructType()


def _is_top(path: Column) -> Column:
    return path.rlike(r"\A(?:`(?:[^`]|``)*`|[^.\[\]`]+)\z")


def state_fields(state: DataFrame) -> DataFrame:
    """(field, n, share): the payloads' own fields, in how many payloads and in what share of all, unparsed ones included."""
    total = state.where("path = ''").agg(F.sum("n").alias("rows"))
    fields = state.where(_is_top(F.col("path"))).groupBy(F.col("path").alias("field")).agg(F.sum("n").alias("n"))
    return fields.crossJoin(F.broadcast(total)).select("field", "n", F.round(F.col("n") / F.col("rows"), 6).alias("share"))


def state_drift(state: DataFrame, since) -> DataFrame:
    """(path, change, types): paths that are new since a day, that were last seen before it, or that have a type they had not before."""
    day = F.lit(str(since)).cast("date")
    new, old = F.col("first_day") >= day, F.col("last_day") < day
    by = state.where(F.col("type") != UNPARSED).groupBy("path").agg(F.bool_and(new).alias("added"), F.bool_and(old).alias("dropped"), F.bool_or(new).alias("retyped"), F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"))
    change = F.when(F.col("added"), "added").when(F.col("dropped"), "dropped").when(F.col("retyped"), "retyped")
    return by.select("path", change.alias("change"), "types").where("change IS NOT NULL")


def schema_sample(batch: DataFrame, history: DataFrame, col: str, rows: int, *, seed: int = 42) -> DataFrame:
    """``rows`` payloads to discover a schema from: of the batch, and where it has fewer, of the history too.

    Which ones depends on their texts and the seed alone, so a run repeated finds the same schema on any cluster. Both are whole if they have no
    more; null payloads are left out. For use where a full discovery is too dear: path_state covers all rows.
    """
    def pick(df, n):
        text = F.col(col)
        return df.select(text.alias(col)).where(text.isNotNull()).orderBy(F.md5(F.concat(F.lit(f"{seed}:"), text)), text).limit(n)

    have = batch.where(F.col(col).isNotNull()).limit(rows).count()
    return pick(batch, rows) if have >= rows else pick(batch, rows).unionByName(pick(history, rows - have))


#: Field of a mixed list's items that keeps, as JSON, what is no object.
REST = "rest"


def element_votes(df: DataFrame, col: str, *, levels: int = 3) -> DataFrame:
    """(level, kind, n): how many items are objects, arrays or scalars, at each level of nested lists."""
    v, out = df.select(F.try_parse_json(F.col(col)).alias("v")).where("v IS NOT NULL"), None
    for level in range(levels):
        v = v.select(F.explode(F.try_variant_get("v", "$", "array<variant>")).alias("v"))
        text = F.schema_of_variant("v")
        kind = F.when(text.startswith("OBJECT"), "object").when(text.startswith("ARRAY"), "array").when(text == "VOID", "null").otherwise("scalar")
        now = v.groupBy(kind.alias("kind")).agg(F.count("*").alias("n")).select(F.lit(level).alias("level"), "kind", "n")
        out = now if out is None else out.unionByName(now)
    return out


def discover_lists(df: DataFrame, col: str, *, levels: int = 3) -> T.ArrayType:
    """The type of lists that discovery alone takes for text, down to the first level with objects among their items.

    Where other items lie beside the objects there, the struct has a field ``rest`` for them (``rest_``, ... if objects have one of that name). Lists
    without objects within ``levels`` keep what discovery finds; if that is no list at all, ValueError.
    """
    votes: dict[int, dict] = {}
    for r in element_votes(df, col, levels=levels).collect():
        votes.setdefault(r["level"], {})[r["kind"]] = r["n"]
    v = df.select(F.try_parse_json(F.col(col)).alias("v"))
    for level in range(levels):
        v = v.select(F.explode(F.try_variant_get("v", "$", "array<variant>")).alias("v"))
        kinds = votes.get(level, {})
        if "object" in kinds:
            objects = v.where(F.schema_of_variant("v").startswith("OBJECT")).select(F.to_json("v").alias("j"))
            found = discover_schema(objects, "j")
            if kinds.keys() - {"object", "null"}:
                name, taken = REST, {f.name.lower() for f in found}
                while name in taken:
                    name += "_"
                found = T.StructType([*found, T.StructField(name, T.StringType())])
            for _ in range(level + 1):
                found = T.ArrayType(found)
            return found
    found = discover_schema(df, col)
    if not isinstance(found, T.ArrayType):
        raise ValueError(f"no lists within {levels} levels")
    return found


def parse_lists(df: DataFrame, col: str, found: T.ArrayType, *, out: str = "parsed") -> DataFrame:
    """``df`` with its lists parsed to a type of discover_lists: objects into their fields, other items as JSON into ``rest``; null where it isn't a list."""
    def items(v: Column, t: T.DataType) -> Column:
        if isinstance(t, T.ArrayType):
            return F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x: items(x, t.elementType))
        if not isinstance(t, T.StructType):
            return F.from_json(F.to_json(v), t) if isinstance(t, T.ArrayType) else F.coalesce(F.try_variant_get(v, "$", t.simpleString()), F.to_json(v).try_cast(t))
        last = t.fields[-1].name if t.fields and re.fullmatch(rf"{REST}_*", t.fields[-1].name) else None
        own = T.StructType([f for f in t if f.name != last])
        is_object = F.schema_of_variant(v).startswith("OBJECT")
        fields = F.from_json(F.when(is_object, F.to_json(v)), own)
        text = F.when(~is_object & (F.schema_of_variant(v) != "VOID"), F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v)))
        parts = [fields[f.name].alias(f.name) for f in own]
        return F.when(F.schema_of_variant(v) != "VOID", F.struct(*parts, *([text.alias(last)] if last else [])))

    return df.withColumn(out, items(F.try_parse_json(F.col(col)), found))
