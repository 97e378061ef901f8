"""Malformed-JSON triage with native expressions: rungs of repair, the first that parses wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.shared import free_name, let, stage

#: Private-use characters that stand for protected ones while quotes are flipped; rows that hold them already are not repaired.
_APOSTROPHE, _QUOTE = "\ue000", "\ue001"
_CURLY = ("“”„‘’", "\"\"\"''")
#: A text's pieces in order: quoted strings of both kinds, and the gaps between them. A string that doesn't end is the last piece. Loops are possessive and every match is kept, so a text is read once and takes no stack, whatever its length.
_PIECES = r"""(?s)"(?:[^"\\]++|\\.)*+(?:"|\\?+\z)|'(?:[^'\\]++|\\.)*+(?:'|\\?+\z)|[^"']++"""
_WHOLE = r"""(?s)"(?:[^"\\]++|\\.)*+"|'(?:[^'\\]++|\\.)*+'"""
# where a bare value may begin and end
_OPEN, _CLOSE = r"([:,\[]\s*+)", r"(?=\s*+[,}\]])"
#: Where a single-quoted value ends for sure: before the next key, or the end of its object.
_ENDS = r"(?=\s*+,\s*+'[^']++'\s*+:|\s*+\})"


def _ok(c: Column) -> Column:
    """Whether a text is one JSON value and nothing else.

    Spark's parser stops where a value ends, whatever follows. So the text is parsed as the only item of a list, with its own hash behind the list,
    which must come out again. A brace with neither a string nor its end behind it is no JSON: most broken texts stop here, without an exception.
    """
    sealed = F.try_parse_json(F.concat(F.lit('{"v":['), c, F.lit('],"w":'), F.xxhash64(c).cast("string"), F.lit("}")))
    whole = let(sealed, lambda v: (F.try_variant_get(v, "$.w", "bigint") == F.xxhash64(c)) & F.try_variant_get(v, "$.v[0]", "variant").isNotNull() & F.try_variant_get(v, "$.v[1]", "variant").isNull())
    return F.when(c.rlike(r'\A\s*+\{\s*+[^"}\s]'), F.lit(False)).otherwise(F.coalesce(whole, F.lit(False)))


def last_key_wins(spark: SparkSession) -> None:
    """Let Spark's JSON parser take objects that repeat a key, the last one winning, from now on in this session."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _straight(c: Column) -> Column:
    return F.translate(c, *_CURLY)


def _by_piece(c: Column, *, double=None, single=None, gap=None, tail=None) -> Column:
    """``c`` with its double- and single-quoted strings, the gaps between them and a string that doesn't end changed, each by its own function."""
    same = lambda x: x

    def change(pieces):
        def one(x, i):
            ended = (i < F.size(pieces) - 1) | F.regexp_like(x, F.lit(rf"\A(?:{_WHOLE})\z"))
            quoted = x.startswith('"') | x.startswith("'")
            return F.when(~quoted, (gap or same)(x)).when(~ended, (tail or same)(x)).when(x.startswith('"'), (double or same)(x)).otherwise((single or same)(x))

        return F.transform(pieces, one)

    return F.array_join(let(F.regexp_extract_all(c, F.lit(_PIECES), F.lit(0)), change), "")


def _bare_literals(gap: Column) -> Column:
    """None, True and False in value position as JSON."""
    for python, json in (("None", "null"), ("True", "true"), ("False", "false")):
        gap = F.regexp_replace(gap, _OPEN + python + _CLOSE, "$1" + json)
    return gap


def _flip(c: Column, *, escape: bool = False) -> Column:
    """Single-quoted strings as double-quoted ones, bare Python literals as JSON; apostrophes between letters and whole double-quoted strings stay.

    ``escape``: double quotes inside a single-quoted string get a backslash, unless they have one.
    """
    kept = F.regexp_replace(c, r"(\p{L})'(?=\p{L})", f"$1{_APOSTROPHE}")

    def single(x):
        inner = F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit("\\'"), F.lit("'"))
        return F.concat(F.lit('"'), F.regexp_replace(inner, r'(?<!\\)((?:\\\\)*+)"', r'$1\\"') if escape else inner, F.lit('"'))

    # a string that doesn't end: what was meant for quotes becomes some, the rest is for the parser to judge
    tail = lambda x: F.when(x.startswith("'"), F.concat(F.lit('"'), F.substring(x, F.lit(2), F.length(x)))).otherwise(F.replace(x, F.lit("'"), F.lit('"')))
    return F.replace(_by_piece(kept, single=single, gap=_bare_literals, tail=tail), F.lit(_APOSTROPHE), F.lit("'"))


def _protect(c: Column, keys: Sequence[str]) -> Column:
    """Apostrophes and double quotes as private-use characters inside single-quoted values: every one of a free-text key, and all that hold JSON text.

    One pass: a value reaches to the first place where one ends for sure. If there is none, no later value has one either, and the rest is one piece.
    """
    named = "".join(rf"|\Q{k}\E" for k in keys)
    opening = rf"'(?:(?:(?!){named})'\s*+:\s*+'|\w++'\s*+:\s*+'(?=[\[{{]))"
    pieces = rf"(?s){opening}(?:[^']++|'(?!{_ENDS}))*+(?:'|\z)|'|[^']++"

    def change(found):
        def one(x, i):
            def inside(head):
                value = F.substring(x, F.length(head) + 1, F.length(x) - F.length(head) - 1)
                return F.when((F.length(head) > 0) & (i < F.size(found) - 1), F.concat(head, F.translate(value, "'\"", _APOSTROPHE + _QUOTE), F.lit("'"))).otherwise(x)

            return F.when(F.length(x) > 1, let(F.regexp_extract(x, rf"\A{opening}", 0), inside)).otherwise(x)

        return F.transform(found, one)

    return F.array_join(let(F.regexp_extract_all(c, F.lit(pieces), F.lit(0)), change), "")


def _restore(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit(_APOSTROPHE), F.lit("'")), F.lit(_QUOTE), F.lit('\\"'))


def _escaped(string: Column) -> Column:
    """A string with its control characters escaped, and each backslash doubled that begins no escape."""
    short = {"\t": "\\t", "\n": "\\n", "\r": "\\r", "\f": "\\f", "\b": "\\b"}
    string = F.regexp_replace(string, r'(?<!\\)((?:\\\\)*+)\\(?!["\\/bfnrtu])', r"$1\\\\")
    every = string
    for code in range(32):
        every = F.replace(every, F.lit(chr(code)), F.lit(short.get(chr(code), f"\\u{code:04x}")))
    return F.when(string.rlike(r"[\x00-\x1f]"), every).otherwise(string)


def _loose(c: Column, numbers: bool, dates: bool) -> Column:
    """Outside strings: unquoted keys, trailing commas and values like 12ab quoted, with flags also 007 and bare dates. Inside: what _escaped mends."""
    def gap(x):
        x = F.regexp_replace(x, r",(?=\s*+[}\]])", "")
        x = F.regexp_replace(x, r"([{,]\s*+)([A-Za-z_]\w*+)(?=\s*+:)", '$1"$2"')
        bare = [r"(?=[\w.-]*[A-Za-z_])\d[\w.-]*+"]
        if dates:
            bare.append(r"\d{4}-\d\d-\d\d(?:[T ][\d:.Z+-]++)?+")
        if numbers:
            bare.append(r"0\d++")
        return F.regexp_replace(x, f"{_OPEN}({'|'.join(reversed(bare))}){_CLOSE}", '$1"$2"')

    return _by_piece(c, double=_escaped, gap=gap)


def _wrapper(c: Column) -> Column:
    """The JSON text inside {'key': '...'} or {'key': {...}}."""
    inner = F.regexp_extract(c, r"(?s)^\s*+\{\s*+'(\w++)'\s*+:\s*+'?+\s*+([\[{].*[\]}])\s*+'?+\s*+\}\s*+$", 2)
    return F.nullif(inner, F.lit(""))


def json_triage(df: DataFrame, col: str, *, free_text_keys: Sequence[str] = (), quote_invalid_numbers: bool = False, quote_bare_dates: bool = False) -> DataFrame:
    """``df`` with payload (JSON text, null where nothing helps) and rung (how it parsed).

    Rungs: 1 as it is; 1b curly quotes straightened, as for all rungs below; 2 JSON text in a single-quoted wrapper; 3 quotes flipped and Python
    literals replaced; 4 free-text keys and JSON text in single-quoted values protected first, double quotes in single-quoted strings escaped; 5
    loose syntax. From rung 3 on, strings and what lies between them are told apart, and each repair works on one of them. Null and empty text
    have no payload. Clean rows never change, a row never fails the job, and each rung reads a text once, in time that grows as its length.

    An object may repeat a key, the last one wins: the session is set so (last_key_wins), for whatever parses the payload later as well.
    """
    last_key_wins(df.sparkSession)
    raw = F.nullif(F.trim(F.col(col)), F.lit(""))
    clean = ~raw.rlike(f"[{_APOSTROPHE}{_QUOTE}]")
    quoting = quote_invalid_numbers, quote_bare_dates

    def parsed(text, rung):
        return let(text, lambda t: F.when(_ok(t), F.struct(t.alias("payload"), F.lit(rung).alias("rung"))))

    def repaired(base):
        quoted = F.contains(base, F.lit("'"))
        spared = lambda flipped: F.when(quoted, parsed(_restore(_flip(_protect(base, free_text_keys), escape=True)), "4"))
        return F.coalesce(
            F.when(base != raw, parsed(base, "1b")), F.when(quoted, parsed(_wrapper(base), "2")),
            let(_flip(base), lambda flipped: F.coalesce(F.when(flipped != base, parsed(flipped, "3")), spared(flipped), parsed(_loose(base, *quoting), "5"), F.when(flipped != base, parsed(_loose(flipped, *quoting), "5")))))

    found = F.when(_ok(raw), F.struct(raw.alias("payload"), F.lit("1").alias("rung"))).otherwise(F.when(clean, let(_straight(raw), repaired)))
    t = free_name(df, "triaged")
    return df.withColumn(t, found).select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in ("payload", "rung")], f"{t}.payload", f"{t}.rung")


def unwrap_envelope(df: DataFrame, col: str, *, exempt_keys: Sequence[str] = (), passes: int = 3, out: str = "payload") -> DataFrame:
    """``df`` with stringified inner JSON in place of its record, and a single key's list in place of its object.

    Values of exempt keys are prose and stay. ``wrapped`` tells whether a row still had an envelope after the last pass. Repeated keys as in json_triage.
    """
    last_key_wins(df.sparkSession)

    def inner(c):
        m = F.from_json(F.when(_ok(c) & c.rlike(r"^\s*\{"), c), "map<string,string>")
        texts = F.map_values(F.map_filter(m, lambda k, v: ~k.isin(list(exempt_keys)) & v.rlike(r"^\s*[\[{]")))
        kinds = F.from_json(F.when(_ok(c) & c.rlike(r"^\s*\{"), c), "map<string,variant>")
        named = F.map_filter(kinds, lambda k, v: ~k.isin(list(exempt_keys)) & (F.schema_of_variant(v) == "STRING") & F.try_variant_get(v, "$", "string").rlike(r"^\s*[\[{]"))
        stringified = F.try_variant_get(F.try_element_at(F.map_values(named), F.lit(1)), "$", "string")
        best = F.when(_ok(stringified), stringified).when(_ok(_flip(stringified)), _flip(stringified))
        listed = F.when((F.size(kinds) == 1) & F.schema_of_variant(F.try_element_at(F.map_values(kinds), F.lit(1))).startswith("ARRAY"), F.try_element_at(texts, F.lit(1)))
        return F.coalesce(best, F.when(_ok(listed), listed))

    df, held = df.withColumn(out, F.col(col)), free_name(df, "inner")
    for _ in range(passes):
        df = df.withColumn(held, inner(F.col(out))).withColumn(out, F.coalesce(held, out)).drop(held)
    return df.withColumn("wrapped", inner(F.col(out)).isNotNull())


def needs_repair(df: DataFrame, col: str) -> bool:
    """Whether any row fails to parse as it is: one aggregate over all rows."""
    last_key_wins(df.sparkSession)
    bad = F.col(col).isNotNull() & (F.trim(F.col(col)) != "") & ~_ok(F.col(col))
    return bool(df.agg(F.bool_or(bad).alias("bad")).first()["bad"])


def rung_mix(df: DataFrame) -> DataFrame:
    """(rung, n), the null rung included."""
    return df.groupBy("rung").agg(F.count("*").alias("n"))


def _walk(df: DataFrame, col: str) -> DataFrame:
    """(id, key, text, named, inner): every string in the distinct payloads that parse, however deep, with the key it stands under.

    ``named`` strings are a key's own value, not an item of its list; ``inner`` ones lie in JSON text that is itself a string. One job for
    each level of nesting, over what is left to open; ``id`` is a 64-bit hash of the payload.
    """
    spark = df.sparkSession
    level = df.select(F.col(col).alias("j")).where(_ok(F.col("j"))).distinct().select(F.xxhash64("j").alias("id"), F.lit(None).cast("string").alias("key"), F.lit(False).alias("inner"), "j")
    found = None
    while True:
        level = stage(level, "walk-level")
        if found is not None and level.isEmpty():
            return found
        opened = spark.sql("SELECT f.id, f.key AS parent, f.inner, c.key, c.value FROM {level} f, LATERAL variant_explode(try_parse_json(f.j)) c", level=level)
        kind = F.schema_of_variant("value")
        opened = opened.select("id", F.coalesce("key", "parent").alias("key"), "inner", F.col("key").isNotNull().alias("named"), (kind == "STRING").alias("is_text"), kind.rlike("^(OBJECT|ARRAY)").alias("deeper"),
                               F.when(kind == "STRING", F.try_variant_get("value", "$", "string")).otherwise(F.to_json("value")).alias("text"))
        opened = stage(opened.where("is_text OR deeper"), "walk")
        texts = opened.where("is_text AND key IS NOT NULL").select("id", "key", "text", "named", "inner")
        found = texts if found is None else found.unionByName(texts)
        nested = F.col("is_text") & F.col("named") & F.col("text").rlike(r"^\s*+[\[{]") & _ok(F.col("text"))
        level = opened.where(F.col("deeper") | nested).select("id", "key", (F.col("inner") | F.col("is_text")).alias("inner"), F.col("text").alias("j"))


# fixed values: classes of what breaks hand-written JSON
BREAKERS = {"apostrophe": "'", "quote": '"', "backslash": r"\\", "newline": "\n", "tab": "\t", "smart_quote": "[‘’“”]", "bare_literal": r"\b(None|True|False|NaN|undefined)\b"}


def breaker_profile(df: DataFrame, col: str) -> DataFrame:
    """(key, breaker, n): in how many distinct payloads a text under a key holds each breaker, at any depth."""
    flags = F.explode(F.array_compact(F.array(*[F.when(F.col("text").rlike(p), F.lit(n)) for n, p in BREAKERS.items()]))).alias("breaker")
    return _walk(df, col).select("id", "key", flags).distinct().groupBy("key", "breaker").agg(F.count("*").alias("n"))


# fixed values: breakers of a payload's structure, each found between its strings
STRUCTURE = {"trailing_comma": r",\s*+[}\]]", "unquoted_key": r"[{,]\s*+[A-Za-z_]\w*+\s*+:", "bare_literal": r"[:,\[]\s*+(?:None|True|False|NaN|undefined)\s*+[,}\]]", "single_quote": r"'", "open_string": r"\ue000"}


def _between(c: Column) -> Column:
    """A text with each whole string as an empty one, and one that doesn't end as a private-use character."""
    def one(x):
        return F.when(~(x.startswith('"') | x.startswith("'")), F.translate(x, _APOSTROPHE, "")).when(~F.regexp_like(x, F.lit(rf"\A(?:{_WHOLE})\z")), F.lit(_APOSTROPHE)).when(x.startswith("'"), F.lit("''")).otherwise(F.lit('""'))

    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_PIECES), F.lit(0)), one), "")


def structure_profile(df: DataFrame, col: str) -> DataFrame:
    """(breaker, n): in how many distinct payloads that don't parse as they are each breaker of structure is found; ``other`` where none is.

    What a string holds counts for nothing here (breaker_profile reads that). Null and blank texts are left out; curly quotes count as straight ones.
    """
    last_key_wins(df.sparkSession)
    raw = F.nullif(F.trim(F.col(col)), F.lit(""))
    broken = df.select(raw.alias("j")).where("j IS NOT NULL").where(~_ok(F.col("j"))).distinct()
    found = broken.select(_between(_straight(F.col("j"))).alias("s")).select(F.array_compact(F.array(*[F.when(F.col("s").rlike(p), F.lit(n)) for n, p in STRUCTURE.items()])).alias("f"))
    names = F.when(F.size("f") > 0, F.col("f")).otherwise(F.array(F.lit("other")))
    return found.select(F.explode(names).alias("breaker")).groupBy("breaker").agg(F.count("*").alias("n"))


def problem_key_profile(triaged: DataFrame, col: str, *, rungs: Sequence[str] = ("4",)) -> DataFrame:
    """(key, rung, n): keys named in rows that only these rungs, or none, could parse."""
    hard = triaged.where(F.col("rung").isNull() | F.col("rung").isin(list(rungs))).where(F.col(col).isNotNull())
    keys = F.explode(F.array_distinct(F.regexp_extract_all(F.col(col), F.lit(r"['\"]?([A-Za-z_]\w*)['\"]?\s*:"), F.lit(1))))
    return hard.select(keys.alias("key"), "rung").groupBy("key", "rung").agg(F.count("*").alias("n"))


def _is_date(text: Column) -> Column:
    """Whether a text is a day that exists, as 2024-01-31, 01/31/2024 or 01-31-2024, or begins as 2024-01-31T10:00:00."""
    formats = {r"^\d{4}-\d\d-\d\d$": "yyyy-MM-dd", r"^\d\d/\d\d/\d{4}$": "MM/dd/yyyy", r"^\d\d-\d\d-\d{4}$": "MM-dd-yyyy", r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d": "yyyy-MM-dd'T'HH:mm:ss"}
    is_date = F.lit(False)
    for pattern, form in formats.items():
        is_date = is_date | (text.rlike(pattern) & F.try_to_timestamp(F.substring(text, 1, 19), F.lit(form)).isNotNull())
    return is_date


def _keys_where(df: DataFrame, col: str, is_it: Column) -> DataFrame:
    own = _walk(df, col).where("named AND NOT inner").where(is_it)
    return own.select("id", "key").distinct().groupBy("key").agg(F.count("*").alias("n"))


def date_like_keys(df: DataFrame, col: str) -> DataFrame:
    """(key, n): keys whose text is a date, at any depth, and in how many distinct payloads."""
    return _keys_where(df, col, _is_date(F.col("text")))


def leading_zero_keys(df: DataFrame, col: str) -> DataFrame:
    """(key, n): keys whose text is a number with a leading zero, at any depth, and in how many distinct payloads."""
    return _keys_where(df, col, F.col("text").rlike(r"^0\d+$"))
