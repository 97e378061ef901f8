"""Token ids in files: frequency-ranked, byte-aligned variable-length coding with separate control bytes.

A segment holds whole documents in ascending id order. Its ids are replaced by their frequency rank in the segment; a rank takes 1 to 4
bytes. Two bits of the control stream say how many, four values a control byte; the data stream has the bytes alone. Decoding looks up
the four lengths of each control byte in a table, with numpy. Segments are rows of Parquet files, so writing, reading, retries
and any store are Spark's: fields part, seq, ids_before (of the part), n_ids, doc_ids, n_tokens, ranked, control, data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.tokens import encoder, slices

#: Bytes of each of the four values of a control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
_PLACES = np.arange(4, dtype=np.uint8)


def encode_ranks(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(ids by falling frequency, control stream, data stream) of unsigned 32-bit ids."""
    if not len(ids):
        return b"", b"", b""
    if ids.max() < 1 << 20:  # a vocabulary's ids: count in a table
        n = np.bincount(ids)
        values = np.flatnonzero(n)
        at, counts = ids, n[values]
    else:
        values, at, counts = np.unique(ids, return_inverse=True, return_counts=True)
    order = np.lexsort((values, -counts))
    rank = np.empty(len(n) if at is ids else len(values), "<u4")
    rank[values[order] if at is ids else order] = np.arange(len(values), dtype="<u4")
    r = rank[at]
    extra = (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    codes = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    codes[: len(r)] = extra
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    data = r.view(np.uint8).reshape(-1, 4)[_PLACES <= extra[:, None]]
    return values[order].astype("<u4").tobytes(), control.tobytes(), data.tobytes()


def decode_ranks(ranked: bytes, control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ids back, as unsigned 32-bit integers."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    out = np.zeros((n, 4), np.uint8)
    out[_PLACES < lengths[:, None]] = np.frombuffer(data, np.uint8)
    return np.frombuffer(ranked, "<u4")[out.reshape(-1).view("<u4")] if n else np.zeros(0, "<u4")


_SEGMENT = "part int, seq int, ids_before bigint, n_ids bigint, doc_ids array<bigint>, n_tokens array<int>, ranked binary, control binary, data binary"


def _segments(path: str, end_id: int, most: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        enc, part = encoder(path), TaskContext.get().partitionId()
        seq, before, docs, counts, parts, held = 0, 0, [], [], [], 0

        def out():
            ids, doc, n = np.concatenate(parts), pa.concat_arrays(docs), np.concatenate(counts)
            one = pa.array([0, len(n)], pa.int32())
            ranked, control, data = encode_ranks(ids)
            columns = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()),
                       pa.ListArray.from_arrays(one, doc), pa.ListArray.from_arrays(one, pa.array(n.astype(np.int32))), *[pa.array([x], pa.binary()) for x in (ranked, control, data)]]
            return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _SEGMENT.split(", ")])

        for b in slices(batches, "text"):
            flat, at = enc.ids(b["text"])
            parts.append(np.insert(flat, at[1:], end_id))
            counts.append(np.diff(at) + 1)
            docs.append(b["doc_id"])
            held += len(parts[-1])
            if held >= most:
                yield out()
                seq, before, docs, counts, parts, held = seq + 1, before + held, [], [], [], 0
        if docs:
            yield out()

    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, segment_ids: int = 1 << 20, parts: int | None = None) -> None:
    """Write the ids of all documents, each with ``end_id`` after it, to files under ``path`` in ascending id order.

    Range partitions by id, one file each, so file order is id order. Segments close at the first slice of
    documents (a megabyte of text, or one longer document) that brings them to ``segment_ids`` ids. Defined results: a null or empty text is ``end_id`` alone; rows that repeat an id are all written, ordered by text;
    null ids come first; an empty table writes no segments; very long texts are encoded whole; other columns are not read, so their names
    cannot clash. Ids are cast to bigint, so a text that is no number counts as a null id.
    """
    n = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).try_cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(_segments(tokenizer, end_id, segment_ids), _SEGMENT).write.parquet(path)


def _decoded(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for b in batches:
        for row in b.to_pylist():
            ids = decode_ranks(row["ranked"], row["control"], row["data"], row["n_ids"])
            n = np.array(row["n_tokens"], np.int64)
            ends = np.cumsum(n)
            raw = ids.tobytes()
            for i in range(0, len(n), 512):
                j = min(i + 512, len(n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * (j - i), pa.int32()), pa.array(row["doc_ids"][i:j], pa.int64()), pa.array(row["ids_before"] + ends[i:j] - n[i:j]), pa.array(n[i:j]),
                     pa.array([raw[4 * (e - k) : 4 * e] for e, k in zip(ends[i:j].tolist(), n[i:j].tolist(), strict=True)], pa.binary())],
                    names=["part", "doc_id", "within", "n_tokens", "ids"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files: ids as little-endian unsigned 32-bit, start the ids of all documents before.

    Defined results: as many rows as were written, in any order; repeated and null ids come back as written; a document without text has its end
    id alone; files without segments give an empty table. A part's place follows from the totals of the parts before it: one row for each file, which is what is broadcast.
    """
    files = spark.read.schema(_SEGMENT).parquet(path)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()  # one row for each file
    starts, at = [], 0
    for r in sorted(totals, key=lambda r: r["part"]):
        starts.append((r["part"], at))
        at += r["n"]
    begin = spark.createDataFrame(starts, "part int, begin bigint")
    rows = files.mapInArrow(_decoded, "part int, doc_id bigint, within bigint, n_tokens bigint, ids binary")
    return rows.join(F.broadcast(begin), "part").select("doc_id", (F.col("begin") + F.col("within")).alias("start"), "n_tokens", "ids")
