"""Raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows of the one before; run() writes each stage's rows as Parquet in the
shared folder and reads them again. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.shared import stage
from strata.llm import line_dedup, mixing, ngram_join, packing, quality_rules
from strata.llm.tokens import default_path

#: Shares of tokens the mix is to have, and its size beside what comes in; to be chosen by the user. Low-quality documents are gone by then, and at 1.1 clean documents have rates of about 1 or more.
TARGETS, SCALE = {"clean": 0.95, "toxic": 0.05}, 1.1

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_text(df: DataFrame, text: str = "text") -> DataFrame:
    """The columns of documents, and no others, with the new text and its length."""
    return df.select("doc_id", F.col(text).alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that break a rule.

    Null, empty and short texts go; repeated rows and null ids are judged each like any other; very long texts are read whole; an empty table stays empty.
    """
    return _with_text(quality_rules.quality_rules(docs).where("kept"), "clean_text")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that many documents share, but for their last holder.

    A null text becomes empty; a text may end up empty, its row stays; repeated rows count as documents each; an empty table stays empty.
    """
    return _with_text(line_dedup.dedup_lines(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, the one with the smallest id.

    Empty texts and rows without an id stay; rows that repeat the smallest id all stay; an empty table stays empty.
    """
    return ngram_join.keep_one(docs).select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says: 0, 1 or more rows.

    Null and empty texts have no tokens and the rate of a text without marked words; repeated rows get equal rates; without labels all domains are
    equal; an empty table stays empty.
    """
    labels = mixing.label_domains(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    mixed = mixing.mix_sources(docs, labels, TARGETS, scale=SCALE)
    return mixed.select(*COLUMNS, F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows, placed in sequences of at most 2048 tokens; an empty text is one end id, an empty table has no pieces."""
    pieces = packing.pack(docs, default_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [
    ("quality_rules", clean_lines),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing", mix),
    ("best_fit_packing", pack),
]

#: Packing needs a tokenizer: SQL cannot express the last stage. tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(COLUMNS)
    for name, f in STAGES:
        docs = stage(f(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
