"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.shared import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each node of ``edges`` with the smallest node it reaches.

    Each pass gives a node to the neighbour, itself included, that a hash of the pass puts first, and makes one node of all that chose the same.
    The hash makes an expected share of the nodes go, whatever the shape, so passes grow as the logarithm of the nodes and each has
    fewer rows; clusters without an edge left are set aside. At the end the labels are handed back, from the last and smallest pass to the
    first. Hot nodes are only ever aggregated with min(). Null ends are ignored.
    """
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    e = stage(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    passes: list[tuple[DataFrame, DataFrame]] = []
    low = None
    while True:
        order = lambda c: F.struct(F.xxhash64(c, F.lit(len(passes))).alias("h"), F.col(c).alias("x"))  # noqa: B023, E731
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        chosen = both.groupBy("u").agg(F.min(order("v")).alias("first")).select("u", F.least("first", order("u"))["x"].alias("label"))
        chosen = chosen.withColumn("low", F.col("u")) if low is None else chosen.join(low.select(F.col("label").alias("u"), "low"), "u")
        chosen = stage(chosen, "chosen")
        low = chosen.groupBy("label").agg(F.min("low").alias("low"))
        passes.append((chosen, low))
        at = lambda c: chosen.select(F.col("u").alias(c), F.col("label").alias(f"{c}_label"))  # noqa: B023, E731
        e = e.where("u <> v").join(at("u"), "u").join(at("v"), "v").where("u_label <> v_label")
        e = stage(e.select(F.greatest("u_label", "v_label").alias("u"), F.least("u_label", "v_label").alias("v")).distinct(), "edges")
        if e.isEmpty():
            break
    found = None
    for chosen, low in reversed(passes):
        labels = low if found is None else low.join(found.withColumnRenamed("node", "label"), "label", "left").select("label", F.coalesce("component", "low").alias("low"))
        found = chosen.select("u", "label").join(labels, "label").select(F.col("u").alias("node"), F.col("low").alias("component"))
        found = stage(found, "found") if len(passes) > 1 else found
    return found
