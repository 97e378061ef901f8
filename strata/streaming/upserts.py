"""A file stream of batches, each applied to a target by key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.dedup import latest_per_key
from strata.operators.upsert import create_keyed, upsert_keyed


def upsert_stream(spark: SparkSession, path: str, schema: T.StructType, table: str, key: str, *, checkpoint: str, event_time: str | None = None, load_time: str = "bronze_updated_at", parts: int | None = None, available_now: bool = True):
    """Read Parquet files as they come and upsert each micro-batch into the keyed table, made by the first one; returns the started query.

    A micro-batch rewrites the parts of its keys alone. Applying one twice changes nothing, so a replay after a failure is safe. Rows without a key are left out.
    """
    def apply(batch: DataFrame, _: int) -> None:
        # in the caller's session, not the stream's copy of it: a session keeps the files of a table it has read until it changes them itself
        if not spark.catalog.tableExists(table):
            first = latest_per_key(batch.where(F.col(key).isNotNull()), [key], [F.col(event_time or load_time).desc_nulls_last()], keep_null_keys=False)
            create_keyed(first, table, key, parts=parts)
        else:
            upsert_keyed(spark, table, batch, key, event_time=event_time, load_time=load_time)

    writer = spark.readStream.schema(schema).parquet(path).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
