"""Language identification by compression: the language whose dictionary makes the text smallest.

Each language has a zstandard raw-content dictionary, cut from a bounded sample of its labelled texts. A text is compressed in
chunks, whole, once with each dictionary; the sums of sizes are compared. A narrow margin is a rejection.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.tokens import slices

_LETTER = regex.compile(r"\p{L}").search

_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def _bound_batches(spark: SparkSession, most: int = 2 << 20) -> None:
    """Batches for Python of about ``most`` bytes, in this session, unless it has a smaller bound. Spark's own is 64 MB, which an
    executor holds for each of its tasks as vectors, as a message and in Python."""
    found = re.fullmatch(r"(\d+)([kmgtp]?)b?", spark.conf.get(_BATCH).lower())
    if not found or int(found[1]) << 10 * " kmgtp".index(found[2] or " ") > most:
        spark.conf.set(_BATCH, str(most))


def fit(labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = 400, snippet: int = 1000, dictionary_bytes: int = 110_000) -> dict[str, bytes]:
    """{language: raw dictionary} from about ``sample`` texts of each language, a snippet of ``snippet`` code points of each.

    The bound on what comes to the driver is languages x sample x snippet; rows are picked by a hash of their id. Rows without a
    language or text teach nothing.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.lower(text_col).alias("text"), F.xxhash64(id_col).alias("h"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return {}
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, sample / n)))])
    picked = rows.where(F.pmod("h", F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
    at = F.pmod(F.shiftright("h", 30), F.greatest(F.length("text") - snippet, F.lit(0)) + 1).cast("int") + 1
    found: dict[str, list] = {}
    for r in picked.select("lang", "h", F.substring("text", at, F.lit(snippet)).alias("text")).orderBy("lang", "h").toLocalIterator():
        if sum(map(len, own := found.setdefault(r["lang"], []))) < dictionary_bytes:
            own.append(r["text"].encode())
    return {k: b"\n".join(v)[:dictionary_bytes] for k, v in sorted(found.items())}


def _predict(model: dict[str, bytes], level: int, chunk: int, min_margin: float):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import zstandard as z

        compress = []
        for raw in model.values():
            d = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            compress.append(z.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_dict_id=False).compress)
        names = list(model)
        import math

        def judge(text):
            if not text or not _LETTER(text) or not names:
                return None, "und", 0.0, True
            raw = text.lower().encode()
            parts = [raw[i : i + chunk] for i in range(0, len(raw), chunk)]
            sizes = [sum(len(c(p)) for p in parts) for c in compress]
            best = min(sizes)
            scale = max(1.0, 0.02 * best)
            score = 1 / sum(math.exp((best - s) / scale) for s in sizes)
            second = min((s for i, s in enumerate(sizes) if i != sizes.index(best)), default=best + 1)
            lang = names[sizes.index(best)]
            rejected = (second - best) < min_margin * second
            return None if rejected else lang, lang, score, rejected

        for b in slices(batches, "text"):
            got = list(zip(*map(judge, b["text"].to_pylist()), strict=True))
            yield pa.RecordBatch.from_arrays([b["id"], *[pa.array(c, t) for c, t in zip(got, (pa.string(), pa.string(), pa.float64(), pa.bool_()), strict=True)]], names=["id", "lang", "nearest", "score", "rejected"])

    return run


def identify(docs: DataFrame, model: dict[str, bytes], *, id_col: str = "doc_id", text_col: str = "text", level: int = 3, chunk: int = 4096, min_margin: float = 0.01) -> DataFrame:
    """(id, lang, nearest, score, rejected) for each row of ``docs``.

    ``nearest`` is the language of the smallest sum; ``lang`` is the same, or null where the second smallest is larger by less than
    ``min_margin`` of itself. ``score`` (0 to 1) is the softmax of the sums, two hundredths of the smallest being one unit.

    Defined results: a null or empty text, one without a letter, or a model without languages gives lang null, nearest ``und``, score 0,
    rejected; ties go to the first language by name and are rejected; each row is judged alone, so repeated rows and null ids
    change nothing; an empty table gives an empty table; other columns are not read, so their names cannot clash.

    Batches for Python are bounded to 2 MB in the session of ``docs`` (a single text may be longer).
    """
    _bound_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_predict(model, level, chunk, min_margin), f"id {kind}, lang string, nearest string, score double, rejected boolean").withColumnRenamed("id", id_col)
