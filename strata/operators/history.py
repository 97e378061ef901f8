"""Version ledgers (SCD2), daily snapshots and merge chains."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.shared import stage

START, END = "VRSN_START_DATE", "VRSN_END_DATE"


def scd2_hash(cols: Sequence[str]) -> Column:
    """md5 of the JSON of a row's business state; null fields drop out."""
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in cols])))


def scd2_apply(ledger: DataFrame, source: DataFrame, key: str, hash_cols: Sequence[str], clock_cols: Sequence[str] = (), *, as_of) -> DataFrame:
    """The ledger after a run: one join of the open versions with the source.

    A key whose state changed closes and opens anew on ``as_of``; an unchanged one gets the source's clocks; a key that left closes; a new or
    returning one opens. Versions are half-open [start, end). Null keys of the source are ignored. Applying the same source twice
    changes nothing.
    """
    day = F.lit(str(as_of)).cast("date")
    source = source.where(F.col(key).isNotNull()).withColumn("HASH_VALUE", scd2_hash(hash_cols))
    names = [c for c in ledger.columns if c not in (START, END)]
    closed = ledger.where(F.col(END).isNotNull())
    t = ledger.where(F.col(END).isNull()).select(F.struct(*ledger.columns).alias("t"))
    s = source.select(F.struct(*[F.col(c) for c in names]).alias("s"))
    both = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    same = F.col("t.HASH_VALUE").eqNullSafe(F.col("s.HASH_VALUE")) & F.col("t").isNotNull() & F.col("s").isNotNull()

    def version(side, start, end, clocks=False):
        return F.struct(*[(start if c == START else end if c == END else F.col(f"s.{c}") if clocks and c in clock_cols else F.col(f"{side}.{c}")).alias(c) for c in ledger.columns])

    old_start, open_end = F.col(f"t.{START}"), F.lit(None).cast("date")
    old = F.when(F.col("t").isNotNull() & ~same, version("t", old_start, day))
    kept = F.when(same, version("t", old_start, open_end, clocks=True))
    new = F.when(F.col("s").isNotNull() & ~same, version("s", day, open_end))
    rows = both.select(F.explode(F.array(old, kept, new)).alias("v")).where("v IS NOT NULL").select("v.*")
    return closed.unionByName(rows)


def scd2_change_log(ledger: DataFrame, key: str, day, cols: Sequence[str]) -> DataFrame:
    """Keys with a version closed and one opened on the day: which of the columns changed, null-safe."""
    d = F.lit(str(day)).cast("date")
    o = ledger.where(F.col(END) == d).select(F.col(key), *[F.col(c).alias(f"old_{c}") for c in cols])
    n = ledger.where(F.col(START) == d).select(F.col(key), *[F.col(c).alias(f"new_{c}") for c in cols])
    changed = F.array_compact(F.array(*[F.when(~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")), F.lit(c)) for c in cols]))
    return o.join(n, key).withColumn("changed", changed)


def daily_snapshot(history: DataFrame | None, ledger: DataFrame, *, as_of, keep_days: int = 90) -> DataFrame:
    """The history with the day's open versions in place of any it had for that day, cut to ``keep_days``."""
    day = F.lit(str(as_of)).cast("date")
    now = ledger.where(F.col(END).isNull()).select(day.alias("run_date"), *[c for c in ledger.columns if c not in (START, END)])
    if history is None:
        return now
    old = history.where((F.col("run_date") != day) & (F.col("run_date") >= F.date_sub(day, keep_days)))
    return old.unionByName(now, allowMissingColumns=True)


def write_snapshot(snapshot: DataFrame, path: str) -> None:
    """One partition a day; a run replaces its own day only."""
    snapshot.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)


def merge_map(pairs: DataFrame, loser: str, winner: str) -> DataFrame:
    """(loser, winner, root, hops): each loser's last winner over any number of merges, by doubling.

    A loser that was merged into several takes the smallest winner; self merges are ignored. On a cycle, every member ends at
    the cycle's smallest id. hops counts the merges after the first; in a cycle, those to the root.
    """
    p = pairs.where(F.col(loser).isNotNull() & F.col(winner).isNotNull() & (F.col(loser) != F.col(winner)))
    direct = stage(p.groupBy(F.col(loser).alias("loser")).agg(F.min(winner).alias("winner")), "merges")
    # jump: the node 2**n steps ahead. Those that have ended are set aside: still looked up, but not joined or written again
    walk = direct.select("loser", F.col("winner").alias("jump"), F.lit(1).cast("long").alias("steps"), F.lit(False).alias("ended"))
    n, bound, done = 0, max(1, direct.count()), []
    while 1 << n <= 2 * bound:
        ahead = walk
        for x in done:
            ahead = ahead.unionByName(x)
        ahead = ahead.select(F.col("loser").alias("__at"), F.col("jump").alias("__to"), F.col("steps").alias("__more"), F.col("ended").alias("__done"))
        walk = stage(walk.join(ahead, F.col("jump") == F.col("__at"), "left").select(
            "loser", F.coalesce("__to", "jump").alias("jump"), (F.col("steps") + F.coalesce("__more", F.lit(0))).alias("steps"), (F.col("__at").isNull() | F.coalesce("__done", F.lit(False))).alias("ended")), "walk")
        done.append(walk.where("ended"))
        walk = walk.where("NOT ended")
        n += 1
        if walk.isEmpty():
            break
    ended = done[0]
    for x in done[1:]:
        ended = ended.unionByName(x)
    ended = ended.select("loser", F.col("jump").alias("root"), (F.col("steps") - 1).alias("hops"))
    if not walk.isEmpty():
        ended = ended.unionByName(_cycles(direct.join(walk.select("loser"), "loser", "left_semi"), walk.select(F.col("jump").alias("loser")).distinct()))
    return direct.join(ended, "loser")


def _cycles(direct: DataFrame, core: DataFrame) -> DataFrame:
    """Roots of losers on or leading into cycles: the smallest id of the cycle. After more steps than there are losers, jumps end on all members of cycles and nowhere else."""
    from strata.functions.graph import components

    label = components(direct, "loser", "winner").select(F.col("node").alias("loser"), "component")
    low = core.join(label, "loser").groupBy("component").agg(F.min("loser").alias("root"))
    return direct.join(label, "loser").join(low, "component").select("loser", "root", F.lit(None).cast("long").alias("hops"))


def merge_fold_report(leads: DataFrame, merges: DataFrame, key: str) -> DataFrame:
    """(leads, persons, folded): ids before and after losers are folded into their roots."""
    m = merges.select(F.col("loser").alias(key), "root")
    folded = leads.select(key).distinct().join(m, key, "left")
    return folded.agg(F.count("*").alias("leads"), F.count_distinct(F.coalesce("root", key)).alias("persons"), F.count("root").alias("folded"))
