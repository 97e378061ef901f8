"""Order MinHash fingerprints: signatures that notice both what a text says and in which order.

k-mers of code points are numbered by occurrence, so each is distinct in its text. For each of ``sketches`` hash orders the ``length`` smallest
are taken, put back into text order, and hashed as one tuple. Two texts agree in a place with a chance that falls with their edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_rng = np.random.default_rng(777)
_U = np.uint64


def _numbered(codes: np.ndarray, k: int) -> np.ndarray:
    """32-bit hashes of the occurrence-numbered k-mers; of all code points as one where they are fewer than k."""
    from strata.llm.wordhash import mix

    n = len(codes)
    if not n:
        return np.zeros(0, np.uint32)
    k = min(k, n)
    total = np.zeros(n - k + 1, np.uint64)
    base = mix(codes.astype(np.uint64), 11)
    for j in range(k):
        total = total * _U(0x9E3779B97F4A7C15) + base[j : n - k + 1 + j]
    h = mix(total, k)
    s = np.sort(h)
    twice = s[1:][s[1:] == s[:-1]]
    if len(twice):
        twice = np.unique(twice)
        at = np.flatnonzero(twice[np.minimum(np.searchsorted(twice, h), len(twice) - 1)] == h)
        order = at[np.argsort(h[at], kind="stable")]
        first = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
        number = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        h[order] = mix(h[order] + number.astype(np.uint64) * _U(0xD1342543DE82EF95), 23) * (number > 0) + h[order] * (number == 0)
    return (h >> _U(32)).astype(np.uint32)


def fingerprint(codes: np.ndarray, *, k: int = 10, length: int = 2, sketches: int = 64) -> np.ndarray:
    """``sketches`` 16-bit values of a text given as code points. A text without any has zeros."""
    from strata.llm.wordhash import mix

    h = _numbered(codes, k)
    if not len(h):
        return np.zeros(sketches, np.uint16)
    odd = (np.random.default_rng(sketches).integers(0, 2**31, sketches, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
    take = min(length, len(h))
    at = np.empty((sketches, take), np.int64)
    step = max(1, (1 << 19) // len(h))  # orders at once, by memory
    for i in range(0, sketches, step):
        v = h[None, :] * odd[i : i + step]
        rows = np.arange(len(v))
        for j in range(take):
            at[i : i + step, j] = best = v.argmin(axis=1)
            v[rows, best] = 0xFFFFFFFF
    at.sort(axis=1)
    out = np.zeros(sketches, np.uint64)
    for j in range(take):
        out = mix(out * _U(0x9E3779B97F4A7C15) + h[at[:, j]].astype(np.uint64), j + 1)
    return (out >> _U(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal places."""
    return float((a == b).mean())


def to_hex(f: np.ndarray) -> str:
    return f.astype(">u2").tobytes().hex()


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """(id, n_chars, fingerprint) for each row; null is empty text. Rows are judged alone, other columns are not read."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            codes = [codes_of(t or "") for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["id"], pa.array([len(c) for c in codes], pa.int64()), pa.array([to_hex(fingerprint(c, **kw)) for c in codes], pa.string())], names=["id", "n_chars", "fingerprint"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, n_chars bigint, fingerprint string").withColumnRenamed("id", id_col)


def _routed(splits, heads):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        first, head = splits.value, heads.value
        for b in batches:
            doc, null = pc.fill_null(b["doc"], 0).to_numpy(zero_copy_only=False), b["doc"].is_null().to_numpy(zero_copy_only=False)
            part = np.maximum(np.searchsorted(first, doc, side="right") - 1, 0)
            part[null] = 0
            ahead = np.flatnonzero(null | np.isin(doc, head))  # rows that begin a part end the one before as well
            at = np.concatenate([np.arange(b.num_rows), ahead])
            part, tail = np.concatenate([part, (part[ahead] - 1) % max(1, len(first))]), np.repeat([0, 1], [b.num_rows, len(ahead)])
            b = b.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(tail.astype(np.int32)), b["doc"], b["text"]], names=["part", "tail", "doc", "text"])

    return run


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """Rows (part, tail, doc, text) in id order inside each part, a task for each, ready for a pass that looks one row ahead.

    Each part ends with a copy of the next part's first row (tail 1); the last part with the first of all. The driver sees, and broadcasts,
    one id for each part. Null ids come before all others.
    """
    ids = docs.select("doc").where("doc IS NOT NULL").repartitionByRange(parts, "doc").groupBy(F.spark_partition_id().alias("p")).agg(F.min("doc").alias("doc"))
    splits = np.array(sorted(r["doc"] for r in ids.collect()), np.int64)
    nulls = docs.where("doc IS NULL").limit(1).count() > 0
    share = docs.sparkSession.sparkContext.broadcast
    rows = docs.select("doc", "text").mapInArrow(_routed(share(splits), share(splits[1:] if nulls else splits)), "part int, tail int, doc bigint, text string")
    return rows.repartitionById(max(1, len(splits)), "part").sortWithinPartitions("part", "tail", "doc", "text")


def fingerprint_edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """Each text's fingerprint beside that of an edited copy, whose last quarter gives way to the start of the next text.

    Returns id, n_chars, edited (text), fingerprint, edited_fingerprint, near_edited, near_next, a row for each row of ``docs``; next is by ascending id, and
    the first row after the last. Texts are shuffled once, by range of id.

    Defined results: null is empty text; ids that repeat are ordered by text; ids that are no whole numbers count as null, and null ids come first; a single row is its own next; an
    empty table gives an empty table; very long texts are read whole; other columns are not read, so their names cannot clash. Equal texts have equal fingerprints.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).try_cast("bigint").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = with_next(rows, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = "doc bigint, n_chars bigint, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = [x.split()[0] for x in schema.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

        def row(now, nxt):
            doc, text, codes, f = now
            q = len(codes) // 4
            edited = np.concatenate([codes[: len(codes) - q], nxt[2][:q]])
            g = fingerprint(edited, **kw) if q else f
            return doc, len(codes), text[: len(text) - q] + nxt[1][:q], to_hex(f), to_hex(g), likeness(f, g), likeness(f, nxt[3])

        out, size, now, part = [], 0, None, None
        for b in batches:
            for p, tail, doc, text in zip(*(b[c].to_pylist() for c in ("part", "tail", "doc", "text")), strict=True):
                if p == part and now is None:
                    continue  # more rows that tie with the tail
                codes = codes_of(text)
                this = (doc, text, codes, fingerprint(codes, **kw))
                if p == part:
                    out.append(row(now, this))
                    size += len(text)
                part, now = p, None if tail else this
                if size > 1 << 20 or len(out) >= 1000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return ordered.mapInArrow(run, schema).withColumnRenamed("doc", id_col)
