"""Line dedup over levelled sorted runs of line hashes.

A run is a table (h1, h2, docs, last), a row for each line key, bucketed and sorted by hash. A batch of documents is aggregated to
such a table and merge-anti-joined with all runs: keys that no run holds become a new run of level 0, and the others, seen before,
are kept as counts to add. Where a level has two runs they are merged into one of the next level, so a key is rewritten only
log(batches) times; runs share no key, and there are at most log(batches) of them. All tables have the same buckets, so joins with runs
and merges of runs shuffle nothing.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.shared import discard, let, shared_path, stage, without

BLANK = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; a text of ASCII alone takes the faster way."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, _UPPER, _LOWER))


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    return ascii_lower(F.btrim(line, F.lit(BLANK)))


def lines_of(text: Column) -> Column:
    """The text split at line feeds; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


_KEY = ["h1", "h2"]


class LineRuns:
    """Levelled runs of line keys with the number of documents and the last one that hold each.

    Runs are bucketed tables whose files lie in the shared folder; close() drops them.
    """

    def __init__(self, spark: SparkSession, buckets: int | None = None):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[str | None] = []
        self.again: list[str | None] = []  # levels too, of keys in later batches that runs held already
        self._paths: dict[str, str] = {}

    def _write(self, df: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self._paths[name] = shared_path(self.spark, "line-run")
        df.write.option("path", self._paths[name]).bucketBy(self.buckets, *_KEY).sortBy(*_KEY).saveAsTable(name)
        return name

    def _drop(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            discard(self.spark, self._paths.pop(name))

    def close(self) -> None:
        self._drop(*list(self._paths))

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(x) for x in self.levels if x]

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The keys (h1, h2, ...) that no run holds: a merge anti-join with each run."""
        for run in self.runs():
            keys = keys.join(run.select(*_KEY).hint("merge"), _KEY, "left_anti")
        return keys

    def add(self, keys: DataFrame) -> None:
        """Add a batch of occurrences (h1, h2, doc), one for each document that holds the key."""
        batch = self._write(keys.groupBy(*_KEY).agg(F.count("*").alias("docs"), F.max("doc").alias("last")))
        if not self.runs():
            self._push(self.levels, batch)
            return
        new = self._write(self.unseen(self.spark.table(batch)))
        self._push(self.again, self._write(self.spark.table(batch).join(self.spark.table(new).select(*_KEY).hint("merge"), _KEY, "left_anti")))
        self._drop(batch)
        self._push(self.levels, new)

    def merged(self, a: DataFrame, b: DataFrame) -> DataFrame:
        """One run of two: a merge of sorted buckets."""
        a, b = a.alias("a"), b.hint("merge").alias("b")
        total = F.coalesce("a.docs", F.lit(0)) + F.coalesce("b.docs", F.lit(0))
        return a.join(b, _KEY, "full_outer").select(*_KEY, total.alias("docs"), F.greatest("a.last", "b.last").alias("last"))

    def _push(self, levels: list[str | None], run: str) -> None:
        for level, held in enumerate(levels):
            if held is None:
                levels[level] = run
                return
            run, levels[level] = self._merge(held, run), None
        levels.append(run)

    def _merge(self, a: str, b: str) -> str:
        one = self._write(self.merged(self.spark.table(a), self.spark.table(b)))
        self._drop(a, b)
        return one

    def frequent(self, min_docs: int) -> DataFrame:
        """Keys (h1, h2, docs, last) that at least ``min_docs`` documents hold, with the last such document."""
        runs = self.runs()
        if again := [x for x in self.again if x]:
            self.again = [functools.reduce(self._merge, again)]
            repeats = self.spark.table(self.again[0]).hint("merge").alias("b")
            total, last = F.col("a.docs") + F.coalesce("b.docs", F.lit(0)), F.greatest("a.last", "b.last")
            runs = [r.alias("a").join(repeats, _KEY, "left").select(*_KEY, total.alias("docs"), last.alias("last")) for r in runs]
        return functools.reduce(DataFrame.unionByName, [r.where(F.col("docs") >= min_docs) for r in runs])


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5, batches: int | None = None) -> DataFrame:
    """``docs`` with frequent lines dropped from all documents but the one with the largest id.

    Keys of at least ``min_chars`` code points in at least ``min_docs`` rows are frequent. Adds n_lines
    (before dropping) and n_dropped; ``text_col`` becomes what is left, joined by line feeds. Columns of
    those names in the input are replaced, all others stay.

    Documents come in ``batches`` (by default 4 and one more for each doubling beyond 2**16 rows: every batch reads all runs before it).
    A row is known by its id and a 64-bit hash of its text, and its lines by their places, so dropping takes one pass over a
    text's lines however many of them go.

    Defined results: a null or empty text is one empty line and stays empty text; a row with a null id
    counts as a document, and loses frequent lines only to one with an id; rows that repeat an id are
    documents of their own, and all of them keep the line where that id is the largest; an empty table gives
    an empty table; a line that repeats inside the keeping document stays each time; very long texts and lines are read whole.
    """
    spark = docs.sparkSession
    docs = without(docs, "n_lines", "n_dropped")
    if batches is None:
        batches = 4 + (docs.count() >> 16).bit_length()
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = F.filter(F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(line_key(x).alias("k"), i.alias("pos"))), lambda s: F.length(s["k"]) >= min_chars)
    hashed = F.sort_array(F.transform(keyed, lambda s: F.struct(F.xxhash64(s["k"]).alias("h1"), F.xxhash64(F.lit("line"), s["k"]).alias("h2"), s["pos"].alias("pos"))))
    # sorted, a line that the row has had before stands next to it
    fresh = let(hashed, lambda a: F.transform(a, lambda s, i: s.withField("first", F.when(i == 0, True).otherwise((F.get(a, i - 1)["h1"] != s["h1"]) | (F.get(a, i - 1)["h2"] != s["h2"])))))
    own = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text).alias("row"), fresh.alias("lines"))
    occ = own.select("doc", "row", F.inline("lines"), F.pmod(F.xxhash64("doc", "row"), F.lit(batches)).cast("int").alias("batch"))
    occ = stage(occ, "line-keys", partition_by=("batch",))
    runs = LineRuns(spark)
    try:
        for b in range(batches):
            runs.add(occ.where((F.col("batch") == b) & F.col("first")).select(*_KEY, "doc"))
        frequent = stage(runs.frequent(min_docs), "line-frequent")
    finally:  # a job that fails leaves no tables behind
        runs.close()
    # keys of more than 2**-16 of the occurrences: 2**16 rows of 32 bytes at most, so broadcasting them is bounded; no other key is hot
    hot = F.col("docs") > (occ.count() >> 16)
    found = [occ.drop("batch").join(F.broadcast(frequent.where(hot)), _KEY), occ.drop("batch").join(frequent.where(~hot), _KEY)]
    lost = functools.reduce(DataFrame.unionByName, found).where(~F.col("doc").eqNullSafe(F.col("last")))
    lost = lost.groupBy("doc", "row").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    d, l = docs.alias("d"), lost.alias("l")
    text, at = F.coalesce(F.col(f"d.`{text_col}`"), F.lit("")), F.col("l.at")
    ends = let(F.concat(F.array(F.lit(-1)), at, F.array(F.lit(2**31 - 2))), lambda e: F.zip_with(F.slice(e, 1, F.size(at) + 1), F.slice(e, 2, F.size(at) + 1), lambda p, q: F.struct(p.alias("p"), q.alias("q"))))
    left = let(F.split(text, "\n", -1), lambda x: F.array_join(F.flatten(F.transform(ends, lambda e: F.slice(x, e["p"] + 2, F.least(e["q"], F.size(x)) - e["p"] - 1))), "\n"))
    left = F.when(at.isNull(), text).otherwise(left)
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1
    out = [left.alias(c) if c.lower() == text_col.lower() else F.col(f"d.`{c}`") for c in docs.columns]
    joined = d.join(l, F.col(f"d.`{id_col}`").eqNullSafe(F.col("l.doc")) & (F.xxhash64(text) == F.col("l.row")), "left")
    return joined.select(*out, n_lines.cast("long").alias("n_lines"), F.coalesce(F.size(at), F.lit(0)).cast("long").alias("n_dropped"))
