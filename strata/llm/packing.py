"""Best-fit packing of tokenized documents into sequences, with a bounded number of open bins."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.shared import stage
from strata.llm.tokens import encoder, slices


class OpenBins:
    """At most ``most`` open bins. ``bits`` has bit f set where an open bin has f free places: the
    best fit is its lowest bit at or above the item's length, the fullest bin its lowest bit of all."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.bits, self.count, self.made = 0, 0, 0
        self.free: list[list[int]] = [[] for _ in range(size + 1)]

    def _take(self, f: int) -> int:
        bin_ = self.free[f].pop()
        if not self.free[f]:
            self.bits ^= 1 << f
        self.count -= 1
        return bin_

    def place(self, n: int) -> tuple[int, int]:
        """The bin of an item of ``n`` places, and its offset there."""
        fits = self.bits >> n
        if fits:
            f = n + (fits & -fits).bit_length() - 1
            bin_ = self._take(f)
        else:
            f, bin_, self.made = self.size, self.made, self.made + 1
            if n < self.size and self.count >= self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
        if left := f - n:
            self.free[left].append(bin_)
            self.bits |= 1 << left
            self.count += 1
        return bin_, self.size - f

    def open(self) -> set[int]:
        return {b for x in self.free for b in x}


def _packed(path: str, size: int, most: int, end_id: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        enc, bins, base = encoder(path), OpenBins(size, most), TaskContext.get().partitionId() << 32
        waiting: dict[int, list] = {}  # the rows of bins that are still open

        def out(rows: list, is_open: bool, id_type):
            doc, piece, ids, bin_, offset = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(doc, id_type), pa.array(piece, pa.int32()), pa.array([p * size for p in piece], pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                 pa.array([base + b for b in bin_], pa.int64()), pa.array(offset, pa.int64()), pa.array([is_open] * len(rows), pa.bool_())],
                names=["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset", "open"])

        id_type = None
        for b in slices(batches, "text"):
            flat, at = enc.ids(b["text"])
            raw = np.insert(flat, at[1:], end_id).astype("<u4").tobytes()
            starts = at + np.arange(len(at))
            id_type = b["doc_id"].type
            for doc, i, j in zip(b["doc_id"].to_pylist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                for k, s in enumerate(range(i, j, size)):
                    n = min(size, j - s)
                    bin_, offset = bins.place(n)
                    waiting.setdefault(bin_, []).append((doc, k, raw[4 * s : 4 * (s + n)], bin_, offset))
            still = bins.open()
            if closed := [r for x in [x for x in waiting if x not in still] for r in waiting.pop(x)]:
                yield out(closed, False, id_type)
        if waiting:
            yield out([r for rows in waiting.values() for r in rows], True, id_type)

    return run


def _repacked(size: int, most: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        bins, base = OpenBins(size, most), (TaskContext.get().partitionId() << 32) | 1 << 62
        for b in batches:
            placed = [bins.place(n) for n in b["used"].to_pylist()]
            yield pa.RecordBatch.from_arrays([b["sequence_id"], pa.array([base + x for x, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())], names=["from_id", "to_id", "shift"])

    return run


def pack(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", size: int = 2048, open_bins: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces of all documents, placed in sequences of at most ``size`` tokens.

    Returns doc_id, piece, start, length, ids (binary, little-endian unsigned 32-bit), sequence_id, offset. A document is its ids and
    ``end_id``; only longer ones than ``size`` are cut. Each task places its own pieces as they come, each in the fullest bin that takes it, and holds ``open_bins`` bins; the bins
    still open at a task's end (a bounded number) are packed once more, as wholes, across tasks.

    Defined results: a null or empty text is ``end_id`` alone; repeated rows are packed each; a null id stays null; an empty table gives no
    pieces; ties between bins with equal room go to the one that came to it last; a very long text is cut to as many pieces as it takes; the id keeps
    its type, whatever it is; other columns are not read, so their names cannot clash.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids binary, sequence_id bigint, offset bigint, open boolean"
    pieces = stage(docs.mapInArrow(_packed(tokenizer, size, open_bins, end_id), schema), "pieces", partition_by=("open",))
    closed, left = pieces.where(~F.col("open")).drop("open"), pieces.where("open").drop("open")
    used = left.groupBy("sequence_id").agg(F.max(F.col("offset") + F.col("length")).alias("used"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    moved = used.repartition(n, "sequence_id").sortWithinPartitions(F.col("used").desc(), "sequence_id").mapInArrow(_repacked(size, open_bins), "from_id bigint, to_id bigint, shift bigint")
    left = left.join(moved, left.sequence_id == moved.from_id).select("doc_id", "piece", "start", "length", "ids", F.col("to_id").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset"))
    return closed.select(left.columns).unionByName(left)
