"""The registered queries of the operators, with their production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.shared import shared_path


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _remainder(n: int):
    """crc32(doc_id as text) mod n; null for a null id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_language_id(spark, sf_dir):
    from strata.llm import language_id

    docs = _docs(spark, sf_dir)
    model = language_id.fit(docs.where(_remainder(3) != 1))
    held = F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out")
    return language_id.identify(docs, model).select("doc_id", held, F.col("nearest").alias("lang_pred"), "score", "rejected")


def op2_line_dedup(spark, sf_dir):
    from strata.llm.line_dedup import dedup_lines

    return dedup_lines(_docs(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def op3_quality_rules(spark, sf_dir):
    from strata.llm.quality_rules import quality_rules

    return quality_rules(_docs(spark, sf_dir).select("doc_id", "text")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars", "base_failed", "kept")


def op4_ngram_jaccard_join(spark, sf_dir):
    from strata.llm.ngram_join import link_components

    return link_components(_docs(spark, sf_dir))


def op5_document_fingerprints(spark, sf_dir):
    from strata.llm.fingerprints import fingerprint_edits

    return fingerprint_edits(_docs(spark, sf_dir)).select("doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op6_best_fit_packing(spark, sf_dir):
    from strata.llm.packing import pack
    from strata.llm.tokens import default_path

    pieces = pack(_docs(spark, sf_dir), default_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


SHARDS = [f"shard-{k:03d}" for k in range(64)]
SLOTS = 6553


def op7_sharding(spark, sf_dir):
    from strata.llm.sharding import assign_shards

    return assign_shards(_docs(spark, sf_dir).select("doc_id"), SHARDS, size=SLOTS).select("doc_id", "slot", "shard")


def op8_quality_classifier(spark, sf_dir):
    from strata.llm import quality_classifier as qc

    docs = _docs(spark, sf_dir)
    model = qc.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").where(_remainder(4) != 2))
    held = F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out")
    return qc.score(docs, model).select("doc_id", held, "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_mixing(spark, sf_dir):
    from strata.llm import mixing

    labels = mixing.label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    mixed = mixing.mix_sources(_docs(spark, sf_dir).select("doc_id", "text"), labels, mixing.TARGETS)
    shares = [F.col("posterior")[k].alias(f"p_{d}") for k, d in enumerate(mixing.TARGETS)]
    return mixed.select("doc_id", "n_tokens", *shares, "rate", "copies")


def op10_token_files(spark, sf_dir):
    from strata.llm.token_files import read_token_files, write_token_files
    from strata.llm.tokens import default_path

    path = shared_path(spark, "token-files")
    write_token_files(_docs(spark, sf_dir), path, default_path("byte_bpe_50k.json"))
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_decontamination(spark, sf_dir):
    from strata.llm.decontaminate import search

    found = search(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=["doc_id"])
    ids = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"), ids, (F.col("n_hit") > 0).alias("contaminated"))


def op12_prefix_trie(spark, sf_dir):
    from strata.llm.prefix_trie import prefix_trie, rebuilt

    return prefix_trie(rebuilt(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def op13_turn_repair(spark, sf_dir):
    from strata.llm.turn_repair import damage, repair_turns

    return repair_turns(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_line_dedup, op3_quality_rules, op4_ngram_jaccard_join, op5_document_fingerprints,
        op6_best_fit_packing, op7_sharding, op8_quality_classifier, op9_mixing, op10_token_files,
        op11_decontamination, op12_prefix_trie, op13_turn_repair,
    )
}


def _op3_sql() -> str:
    from strata.llm.quality_rules import BOILERPLATE, SEPARATORS

    n = lambda col, pattern: f"len(regexp_extract_all({col}, '{pattern}'))"
    blank = "[ \\t\\n\\x0B\\f\\r]"
    boiler = BOILERPLATE.removeprefix("(?i)")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+') AS w FROM documents),
p AS (SELECT doc_id, i, list_slice(w, i, i + 7) AS g FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 6, 1))) AS i)),
r AS (SELECT doc_id, i FROM p WHERE len(g) = 8 QUALIFY count(*) OVER (PARTITION BY doc_id, md5(array_to_string(g, ' '))) > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(0, 8) AS t(k) GROUP BY doc_id),
l AS (SELECT doc_id, i, line, {n("line", "[^ \\t\\n\\x0B\\f\\r]+")} AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)),
v AS (SELECT *, n > 0 AND ({n("line", "[#*$%&<>]")} > 0.3 * n OR {n("line", "[!?]")} > 0.3 * greatest(n, 4)
  OR ({n("line", SEPARATORS)} >= 3 AND {n("line", SEPARATORS)} > 0.15 * n) OR (n <= 40 AND regexp_matches(line, '{boiler}', 'i'))) AS fails FROM l),
s AS (SELECT doc_id, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS dup,
  coalesce(sum(length(regexp_replace(line, '{blank}+', '', 'g'))) FILTER (fails), 0)::BIGINT AS lost FROM v GROUP BY doc_id),
f AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, {n("text", "[#*$%&|<>]")}::BIGINT AS n_symbols,
  dup::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words, lost AS lost_chars FROM d JOIN s USING (doc_id) LEFT JOIN c USING (doc_id))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
 NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND lost_chars <= 0.5 * word_chars AS kept FROM f"""


_OP2_SQL = """
WITH l AS (SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
f AS (SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.*, f.k IS NOT NULL AND l.doc_id <> f.last AS lost FROM l LEFT JOIN f ON l.k = f.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (lost)::BIGINT AS n_dropped,
 sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM m GROUP BY doc_id"""


_OP4_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t\\n\\x0B\\f\\r]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g FROM w, LATERAL (SELECT unnest(range(1, greatest(len(w) - 3, 2))) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
r(x, y) AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m.y, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT x, min(y) AS y FROM r GROUP BY x) m ON m.x = d.doc_id"""


def _op7_sql() -> str:
    from strata.llm.sharding import fill_table

    table = ", ".join(map(str, fill_table(SHARDS, SLOTS)))
    return f"""
WITH s AS (SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS})::BIGINT AS slot FROM documents)
SELECT doc_id, slot, 'shard-' || lpad(([{table}])[slot + 1]::VARCHAR, 3, '0') AS shard FROM s"""


_OP11_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
v AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + 9), ' ') AS g FROM b, LATERAL (SELECT unnest(range(1, greatest(len(w) - 8, 2))) AS i) WHERE len(w) > 0),
p AS (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM (SELECT * FROM d, (SELECT DISTINCT n FROM v) WHERE len(w) >= n), LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)),
h AS (SELECT doc_id, i, n, g FROM p WHERE (n, g) IN (SELECT n, g FROM v)),
c AS (SELECT doc_id, count(DISTINCT k)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h JOIN v USING (n, g)) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text in DuckDB, bit by bit: the polynomial 0xEDB88320 is the checksum's."""
    byte = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda k, z: xor(k >> 1, 3988292384 * (k & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: {byte}), 4294967295)"


_OP12_SQL = f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_crc32("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, i, role, text FROM c JOIN t ON t.conv_id = c.base AND i <= h UNION ALL
  SELECT c.conv_id, i, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND i > h),
k AS (SELECT conv_id, row_number() OVER w AS depth, string_agg(md5(length(role) || ':' || role || text), '') OVER (w ROWS UNBOUNDED PRECEDING) AS p, length(text) AS n FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
m AS (SELECT conv_id, depth, p, n FROM k UNION ALL SELECT conv_id, 0, '', 0 FROM c),
e AS (SELECT p, string_agg(conv_id, ',' ORDER BY conv_id) AS ends FROM (SELECT conv_id, arg_max(p, depth) AS p FROM m GROUP BY conv_id) GROUP BY p),
v AS (SELECT p, min(conv_id) AS conv_id, min(depth) AS depth, count(*) AS n_convs, any_value(n) AS n FROM m GROUP BY p),
u AS (SELECT left(p, length(p) - 32) AS p, count(*) AS kids FROM v WHERE depth > 0 GROUP BY 1),
w AS (SELECT v.*, coalesce(kids, 0) AS kids FROM v LEFT JOIN u USING (p)),
s AS (SELECT m.p, count(*) FILTER (kids = 0) AS n_leaves, sum((n_convs - 1) * w.n) AS saved FROM w JOIN m ON m.conv_id = w.conv_id AND m.depth <= w.depth GROUP BY m.p)
SELECT w.conv_id, w.depth::BIGINT AS depth, a.conv_id AS parent_conv_id, w.n_convs::BIGINT AS n_convs, w.kids::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM w JOIN s ON s.p = w.p LEFT JOIN e ON e.p = w.p LEFT JOIN v a ON w.depth > 0 AND a.p = left(w.p, length(w.p) - 32)"""


# states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; each step takes one row and then up to three inserts
_OP13_SQL = f"""
WITH RECURSIVE a AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS d FROM conversations),
x AS (SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE d WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM a WHERE d > 0),
y AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM x),
z AS (SELECT *, left(role, 1) AS r, CASE WHEN NOT regexp_matches(text, '[^ \t\n\x0B\f\r]') THEN 1 WHEN seen > 1 THEN 2 WHEN NOT regexp_matches(text, '[.!?][ \t\n\x0B\f\r]*\\z') THEN 3 ELSE 0 END AS fault FROM y),
o AS (SELECT DISTINCT conv_id FROM conversations),
ins AS (SELECT * FROM (VALUES (0, 0, 0, []), (1, 1, 0, []), (2, 2, 0, []), (3, 3, 0, []), (0, 2, 1, ['user:']), (1, 2, 1, ['user:']), (2, 3, 1, ['assistant:']), (3, 2, 1, ['user:']),
  (0, 3, 2, ['user:', 'assistant:']), (1, 3, 2, ['user:', 'assistant:'])) AS q(s0, s1, k, added)),
f AS (SELECT conv_id, 0::BIGINT AS i, s1 AS s, 5 * k AS cost, repeat('I', k) AS audit, added AS turns FROM o, ins WHERE s0 = 0
 UNION ALL
 SELECT conv_id, i, s, cost, audit, turns FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id, s ORDER BY cost, audit) AS best FROM (
   SELECT g.conv_id, g.i, s1 AS s, g.cost + 5 * k AS cost, g.audit || repeat('I', k) AS audit, list_concat(g.turns, added) AS turns FROM (
    SELECT f.conv_id, z.i, e.s1 AS st, f.cost + e.c + CASE WHEN z.fault = 3 AND e.op <> 'D' THEN 5 ELSE 0 END AS cost, f.audit || e.op AS audit,
     CASE e.op WHEN 'D' THEN f.turns WHEN 'K' THEN list_append(f.turns, z.role || ':' || z.text) ELSE list_append(f.turns, e.role || ':' || z.text) END AS turns
    FROM f JOIN z ON z.conv_id IS NOT DISTINCT FROM f.conv_id AND z.i = f.i + 1
    JOIN (VALUES ('D', 0, 0, '', '', 2), ('D', 1, 1, '', '', 2), ('D', 2, 2, '', '', 2), ('D', 3, 3, '', '', 2), ('K', 0, 1, 's', '', 0), ('K', 0, 2, 'u', '', 0), ('K', 1, 2, 'u', '', 0), ('K', 3, 2, 'u', '', 0), ('K', 2, 3, 'a', '', 0),
     ('R', 0, 2, '', 'user', 1), ('R', 1, 2, '', 'user', 1), ('R', 2, 3, '', 'assistant', 1), ('R', 3, 2, '', 'user', 1)) AS e(op, s0, s1, r, role, c)
    ON e.s0 = f.s AND (e.op = 'D' OR (z.fault NOT IN (1, 2) AND (e.op = 'R' OR e.r = z.r)))) g JOIN ins ON ins.s0 = g.st)) WHERE best = 1),
n AS (SELECT conv_id, max(i) AS rows_left, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
  count(*) FILTER (i > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM (SELECT *, lag(r) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM z) GROUP BY conv_id),
b AS (SELECT o.conv_id, f.cost, f.audit, f.turns, row_number() OVER (PARTITION BY o.conv_id ORDER BY f.cost, f.audit) AS best, n.* EXCLUDE (conv_id)
  FROM o LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM o.conv_id JOIN f ON f.conv_id IS NOT DISTINCT FROM o.conv_id AND f.i = coalesce(n.rows_left, 0) AND f.s IN (0, 3))
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
 cost::BIGINT AS cost, audit, sha256(array_to_string(turns, chr(10))) AS repaired_sha256 FROM b WHERE best = 1"""


def oracle_sql() -> dict[str, str]:
    return {"op11_decontamination": _OP11_SQL, "op12_prefix_trie": _OP12_SQL, "op13_turn_repair": _OP13_SQL, "op2_line_dedup": _OP2_SQL, "op3_quality_rules": _op3_sql(), "op4_ngram_jaccard_join": _OP4_SQL, "op7_sharding": _op7_sql()}
