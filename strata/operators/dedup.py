"""Dedup, survivorship and incremental filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.shared import stage


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], *, keep_null_keys: bool = True) -> DataFrame:
    """One row for each key, the first by ``order``; rows with a null key stay as they are, or go."""
    has_key = F.lit(True)
    for k in keys:
        has_key &= F.col(k).isNotNull()
    ranked = df.where(has_key).withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    best = ranked.where("__rank = 1").drop("__rank")
    return best.unionByName(df.where(~has_key)) if keep_null_keys else best


def byte_dedup(df: DataFrame, col: str, order: Sequence[Column]) -> DataFrame:
    """Byte-equal payloads once, the first seen; adds payload_hash."""
    return latest_per_key(df.withColumn("payload_hash", F.md5(F.col(col))), ["payload_hash"], order)


def canonical_dedup(df: DataFrame, payload_col: str, order: Sequence[Column]) -> DataFrame:
    """JSON payloads equal up to key order and spacing once, the first by ``order``; rows that don't parse stay."""
    canon = F.md5(F.to_json(F.try_parse_json(F.col(payload_col))))
    return latest_per_key(df.withColumn("canonical_hash", canon), ["canonical_hash"], order)


def skip_known(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key ``known`` doesn't hold."""
    return df.join(known.select(key).distinct(), key, "left_anti")


def create_known(df: DataFrame, name: str, key: str, *, buckets: int | None = None) -> None:
    """Keep the distinct non-null keys of ``df`` as a managed table bucketed by key, for skip_kept; as many buckets as shuffle partitions, or more."""
    n = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.select(key).where(F.col(key).isNotNull()).repartition(n, key).distinct().write.bucketBy(n, key).sortBy(key).saveAsTable(name)


def skip_kept(df: DataFrame, name: str, key: str) -> DataFrame:
    """Rows whose key the table of create_known doesn't hold; null keys stay. The table is partitioned by key already: only ``df`` is shuffled."""
    return df.join(df.sparkSession.table(name).select(key), key, "left_anti")


def add_known(df: DataFrame, name: str, key: str) -> DataFrame:
    """Rows whose key is new, each key once, staged; their keys are added to the table. A batch given twice adds nothing."""
    spark = df.sparkSession
    new = stage(skip_kept(df.where(F.col(key).isNotNull()), name, key).dropDuplicates([key]), "new-keys")
    n = int(spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").first()["data_type"])
    new.select(key).repartition(n, key).write.bucketBy(n, key).sortBy(key).mode("append").saveAsTable(name)
    return new


def replay_filter(df: DataFrame, hashes: DataFrame, key: str = "payload_hash") -> DataFrame:
    """Rows whose key is among ``hashes``."""
    return df.join(hashes.select(key).distinct(), key, "left_semi")


def cdc_watermark(df: DataFrame, col: str):
    """The largest value of ``col``; None for an empty table."""
    return df.agg(F.max(col)).first()[0]


def cdc_filter(df: DataFrame, col: str, watermark) -> DataFrame:
    """Rows after the watermark; all rows when there is none."""
    return df if watermark is None else df.where(F.col(col) > F.lit(watermark))


def find_event_time(schema: T.StructType, candidates: Sequence[str]) -> str | None:
    """The first candidate that is a scalar column, in any case."""
    scalar = {f.name.lower(): f.name for f in schema if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))}
    return next((scalar[c.lower()] for c in candidates if c.lower() in scalar), None)


def version_distribution(df: DataFrame, key: str) -> DataFrame:
    """(versions, keys): how many keys have how many rows."""
    return df.groupBy(key).agg(F.count("*").alias("versions")).groupBy("versions").agg(F.count("*").alias("keys"))
