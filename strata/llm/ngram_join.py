"""Similarity self-join of documents on word n-grams: a blocked sparse matrix product with size-derived bounds.

The matrix has a row for each distinct n-gram set and a column for each n-gram. Two sets of sizes m and n that reach the
similarity t share at least o(m, n) = ceil(t (m + n) / (1 + t)) n-grams, so, with all n-grams in one global order, their first m - o + l
and n - o + l entries share at least l. Only the leading entries that this can ever ask for are stored, a block for each column. Products of blocks
are summed to overlap counts, pairs below l are dropped, and the others' overlap is accumulated over slices of all columns until it
reaches o or cannot.

Blocks never emit all their pairs. First each is multiplied by one row, its pivot (a star), and each row is compared in full with
the pivot of the largest count; accepted pairs join rows to components. While large columns are left, rows of other components get pivots
again. Then only pairs across components are left, and the product is complete: a pair inside a component changes nothing. A column of
many rows is cut to row blocks, and its product is dealt by (i, j) pairs of them. Documents with equal sets are one row from the start.

The order puts frequent n-grams last: those most frequent in one of 32 of the distinct texts, ``heavy`` of them at
most. The order decides speed alone, not results.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.graph import components
from strata.functions.shared import stage
from strata.llm.tokens import slices


def overlap_bound(m, n, percent: int):
    """The least overlap of sets of sizes m and n with a Jaccard similarity of ``percent`` hundredths, for integers."""
    return (percent * (m + n) + 99 + percent) // (100 + percent)


def _bound(m: Column, n: Column, percent: int) -> Column:
    return F.ceil(F.lit(percent) * (m + n) / F.lit(100 + percent) - 1e-9).cast("int")


def _sets(batches: Iterator, k: int) -> Iterator:
    from strata.llm.wordhash import shingles, signature, words

    for b in slices(batches, "text"):
        for i, s in enumerate(shingles(*words(b["text"]), k)):
            yield b, i, s, signature(s) if len(s) else None


def _rows(made: Iterator, schema, most: int = 1 << 18) -> Iterator:
    """Record batches of rows (tuples), about ``most`` n-grams each."""
    import pyarrow as pa

    rows, held = [], 0
    for row in made:
        rows.append(row)
        held += 1 + sum(len(x) for x in row if hasattr(x, "__len__"))
        if held >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _members(k: int):
    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("doc", pa.int64()), ("n", pa.int32()), ("cls", pa.int64())])
        yield from _rows(((b["doc"][i].as_py(), len(s), c) for b, i, s, c in _sets(batches, k)), schema)

    return run


def _grams(k: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("grams", pa.list_(pa.int64()))])
        yield from _rows(((s.view(np.int64),) for _, _, s, c in _sets(batches, k) if c is not None), schema)

    return run


def _leading(k: int, percent: int, heavy):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        values, rank, hot_from = heavy.value
        seen: set[int] = set()

        def order(s, p):
            """The first p n-grams: light ones by hash, then heavy ones, rarest first; and how many of them are hot."""
            for part in (s[: 2 * p], s):
                at = np.minimum(np.searchsorted(values, part), max(len(values) - 1, 0))
                is_heavy = values[at] == part if len(values) else np.zeros(len(part), bool)
                light = part[~is_heavy]
                if len(light) >= p:
                    return light[:p], 0
            by_rank = np.argsort(rank[at[is_heavy]], kind="stable")[: p - len(light)]
            return np.concatenate([light, part[is_heavy][by_rank]]), int((rank[at[is_heavy]][by_rank] >= hot_from).sum())

        def made():
            for _, _, s, c in _sets(batches, k):
                if c is not None and c not in seen:  # a text's copies in one task add nothing
                    if len(seen) >= 1 << 17:
                        seen.clear()
                    seen.add(c)
                    grams, hot = order(s, len(s) - overlap_bound_own(len(s), percent) + 1)
                    yield c, len(s), hot, grams.view(np.int64)

        yield from _rows(made(), pa.schema([("cls", pa.int64()), ("n", pa.int32()), ("hot", pa.int32()), ("grams", pa.list_(pa.int64()))]))

    return run


def overlap_bound_own(n: int, percent: int) -> int:
    """The least overlap of a set of size n with any similar set."""
    return -(-percent * n // 100)


#: Most pairs of rows that are broadcast to the sets (24 bytes each); beyond, the sets are shuffled to them.
BROADCAST_PAIRS = 1 << 20
#: Rows of a column that are multiplied by each other in one task; columns with more are cut to blocks of as many.
BLOCK = 4096
#: Most bits of the filter of wanted ids that is broadcast (8 MB); beyond, texts are joined by id instead.
FILTER_BITS = 1 << 26


def _places(ids, bits: int):
    """Three places of each id in a filter of ``bits`` bits (a power of two)."""
    import numpy as np

    from strata.llm.wordhash import mix

    return [mix(ids.astype(np.uint64), salt) & np.uint64(bits - 1) for salt in (31, 32, 33)]


def _masks(bits: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            at = np.concatenate(_places(b["rep"].to_numpy(zero_copy_only=False), bits))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int32)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["word", "mask"])

    return run


def _sets_of(k: int, bits: int, words):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        schema = pa.schema([("cls", pa.int64()), ("grams", pa.binary())])

        def some():
            for b in batches:
                b = b.filter(pc.is_valid(b["doc"]))
                if words is None or not b.num_rows:
                    yield b
                    continue
                hit = np.ones(b.num_rows, bool)
                for at in _places(b["doc"].to_numpy(), bits):
                    hit &= (words.value[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
                yield b.filter(pa.array(hit))

        yield from _rows(((c, _packed(s)) for _, _, s, c in _sets(some(), k) if c is not None), schema)

    return run


def _fetch(text: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(cls, grams) of the wanted rows (cls, rep), staged; a few others may be among them.

    Ids pass through a Bloom filter of 16 bits each where it fits FILTER_BITS, so that texts aren't shuffled; else texts are joined by id.
    """
    import numpy as np

    spark, n = text.sparkSession, wanted.count()
    bits = 1 << max(16, (16 * n).bit_length())
    if bits <= FILTER_BITS:
        got = wanted.select("rep").where("rep IS NOT NULL").mapInArrow(_masks(bits), "word int, mask bigint").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
        words = np.zeros(bits >> 6, np.uint64)
        words[got["word"].to_numpy()] = got["mask"].to_numpy().view(np.uint64)
        made = text.mapInArrow(_sets_of(k, bits, spark.sparkContext.broadcast(words)), "cls bigint, grams binary")
    else:
        made = text.join(wanted.select("rep"), text.doc == F.col("rep"), "left_semi").mapInArrow(_sets_of(k, bits, None), "cls bigint, grams binary")
    return stage(made, "sets")


def _packed(s) -> bytes:
    """The upper 48 bits of sorted 64-bit hashes, six bytes each."""
    import numpy as np

    return np.ascontiguousarray(s.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpacked(raw: bytes):
    import numpy as np

    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view(">u8").ravel().astype(np.uint64)


#: Ends of the column slices over which an overlap is accumulated: 1/16, 1/4 and all of the hash range.
SLICES = (1 << 60, 1 << 62, 1 << 64)


def overlaps(a, b, percent: int) -> bool:
    """Whether two sorted sets reach the bound: their overlap grows slice by slice, and stops once it cannot."""
    import numpy as np

    o, count = overlap_bound(len(a), len(b), percent), 0
    i = j = 0
    for end in SLICES:
        i2, j2 = (len(a), len(b)) if end == 1 << 64 else (int(np.searchsorted(a, np.uint64(end))), int(np.searchsorted(b, np.uint64(end))))
        both = np.concatenate([a[i:i2], b[j:j2]])
        both.sort(kind="stable")
        count += int((both[1:] == both[:-1]).sum())
        i, j = i2, j2
        if count + min(len(a) - i, len(b) - j) < o:
            return False
    return True


def _accepted(percent: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for t in batches:
            keep, last, a = [], None, None
            for raw_a, raw_b in zip(t["grams_a"], t["grams_b"], strict=True):
                if (now := raw_a.as_py()) != last:
                    last, a = now, _unpacked(now)
                keep.append(overlaps(a, _unpacked(raw_b.as_py()), percent))
            at = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays([t["a"].take(pa.array(at)), t["b"].take(pa.array(at))], names=["a", "b"])

    return run


def _heavy(docs: DataFrame, k: int, share: int, most: int):
    """(sorted hashes, rank by rising frequency, least rank of a hot one) of at most ``most`` n-grams: 16 bytes each is the bound of the broadcast.

    Hot are those with 2**-16 of all n-grams of the sample or more, so there are 2**16 at most.
    """
    import numpy as np

    sample = docs.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0).select("text").distinct()
    counts = sample.mapInArrow(_grams(k), "grams array<bigint>").select(F.explode("grams").alias("gram")).groupBy("gram").count().where("count > 1")
    counts = stage(counts, "heavy")
    level = counts.groupBy("count").agg(F.count("*").alias("n")).orderBy(F.col("count").desc()).limit(10_000).collect()
    total, least = 0, None
    for r in level:
        total += r["n"]
        if total > most:
            break
        least = r["count"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
    got = counts.where(F.col("count") >= least).toArrow()
    gram = got["gram"].to_numpy().view(np.uint64)
    order = np.argsort(gram)
    gram, n = gram[order], got["count"].to_numpy()[order]
    rank = np.empty(len(gram), np.int64)
    rank[np.lexsort((gram, n))] = np.arange(len(gram))
    hot = max(4, sum(r["n"] * r["count"] for r in level) >> 16)
    return gram, rank, int((n < hot).sum())


def _columns(rows: DataFrame) -> DataFrame:
    """For each column with rows (gram, cls, n, pos, comp) of two components or more: how many rows, and its pivot, the row of the smallest place.

    Aggregated before the shuffle, so a column of any length weighs one row a task.
    """
    key = F.shiftleft(F.least("pos", F.lit(65535)).cast("bigint"), 47).bitwiseOR(F.shiftrightunsigned("cls", 17))
    pivot = [F.min_by(c, key).alias(f"p_{c}") for c in ("cls", "n", "pos", "comp")]
    return rows.groupBy("gram").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("rows"), *pivot).where("lo <> hi").drop("lo", "hi")


def _prefix(m: Column, n: Column, pm: Column, pn: Column, least, percent: int) -> Column:
    """Whether entries at the places pm and pn may be among the ``least`` first that similar sets of sizes m and n share."""
    o = _bound(m, n, percent)
    return (pm < m - o + least) & (pn < n - o + least)


def _stars(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): each row b with the pivot a of another component that it shares most columns with."""
    other = (F.col("comp") != F.col("p_comp")) & _prefix(F.col("n"), F.col("p_n"), F.col("pos"), F.col("p_pos"), 1, percent)
    shared = rows.where(other).groupBy(F.col("p_cls").alias("a"), F.col("cls").alias("b")).agg(F.count("*").alias("c"))
    return shared.groupBy("b").agg(F.max_by("a", F.shiftleft("c", 32).bitwiseOR(F.pmod("a", F.lit(1 << 32)))).alias("a")).select("a", "b")


def _product(rows: DataFrame, percent: int, shared: int) -> DataFrame:
    """(a, b): pairs of rows (gram, cls, n, pos, comp, rows) of different components that share as many leading entries as similar ones must.

    A column of ``rows`` rows has k = ceil(rows / BLOCK) blocks; the product of blocks i and j is dealt by (gram, i, j), so that no task gets
    more than BLOCK x BLOCK pairs of it at once.
    """
    own = lambda x: F.ceil(F.lit(percent) * x / 100.0 - 1e-9)

    def least(m, n):
        """How many entries the stored prefixes of two similar sets share at least, up to ``shared``: more would multiply the products for little."""
        return F.least(_bound(m, n, percent) - F.greatest(own(m), own(n)) + 1, F.lit(shared)).cast("int")

    k = F.ceil(F.col("rows") / float(BLOCK)).cast("int")
    cut = rows.withColumn("block", F.pmod(F.xxhash64("cls"), k).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), k - 1))).select("gram", "cls", "n", "pos", "comp", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    x, y = cut.alias("x"), cut.alias("y")
    n_x, n_y = F.col("x.n"), F.col("y.n")
    once = (F.col("x.block") != F.col("y.block")) | (F.col("x.i") == F.col("x.j"))  # rows of one block meet in (i, i) alone
    met = (F.col("x.gram") == F.col("y.gram")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j")) & (F.col("x.cls") < F.col("y.cls")) & (F.col("x.comp") != F.col("y.comp")) & once
    pairs = x.join(y, met & _prefix(n_x, n_y, F.col("x.pos"), F.col("y.pos"), least(n_x, n_y), percent))
    counts = pairs.groupBy(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"), n_x.alias("m"), n_y.alias("n")).agg(F.count("*").alias("c"))
    return counts.where(F.col("c") >= least(F.col("m"), F.col("n"))).select("a", "b")


def link_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75, sample_share: int = 32, heavy: int | None = None, shared: int = 3) -> DataFrame:
    """(id, n_shingles, component_id), a row for each row of ``docs``: the smallest id reachable over links of ``percent`` or more.

    Sets are of distinct k-word shingles of the text, A-Z lower-cased; a text with fewer words has one shingle, all its words; one without
    words, null included, has an empty set and links with nothing. Other columns are not read, so
    their names cannot clash. ``heavy`` is a row in 8, but 2**18 at least and 2**20 at most, if not given.

    Defined results: rows with equal sets are linked, repeated rows too; a row with a null id joins its equals' component, or has a null
    component_id; very long texts are handled whole; an empty table gives an empty table. Ids are bigint; one that is no whole number counts as null. Sets are compared by
    64-bit hashes (two of n sets are taken for one with a chance of n**2 / 2**65), their n-grams by 48 bits of one (one more in common than there
    is, with a chance of m * n / 2**48 for a pair).
    """
    spark = docs.sparkSession
    text = docs.select(F.col(id_col).try_cast("bigint").alias("doc"), F.col(text_col).alias("text"))
    members = stage(text.mapInArrow(_members(k), "doc bigint, n int, cls bigint"), "members")
    reps = members.where("n > 0").groupBy("cls").agg(F.min("doc").alias("rep"), F.count("*").alias("copies"))
    n_rows = members.count()

    if heavy is None:
        heavy = min(max(n_rows >> 3, 1 << 18), 1 << 20)
    order = spark.sparkContext.broadcast(_heavy(text, k, sample_share, heavy))
    leading = text.mapInArrow(_leading(k, percent, order), "cls bigint, n int, hot int, grams array<bigint>")
    # one word holds the upper 48 bits of the n-gram and its place (at most 65535: a smaller place only prunes less); hot columns are dealt in 64 parts
    entry = F.shiftleft(F.shiftright("g", 16), 16).bitwiseOR(F.least("p", F.lit(65535)).cast("bigint")).alias("entry")
    salt = F.when(F.col("p") >= F.size("grams") - F.col("hot"), F.pmod(F.xxhash64("cls"), F.lit(64)) + 1).otherwise(0).cast("byte").alias("salt")
    entries = leading.select("cls", "n", "hot", "grams", F.posexplode("grams").alias("p", "g")).select(entry, "cls", "n", salt).repartition(F.shiftright("entry", 16), "salt")
    entries = entries.select(F.shiftright("entry", 16).alias("gram"), "salt", "cls", "n", F.col("entry").bitwiseAND(F.lit(65535)).cast("int").alias("pos"))
    column = Window.partitionBy("gram", "salt")
    pivot = F.min(F.struct("pos", "n", "cls")).over(column)
    blocks = entries.select("*", F.min("cls").over(column).alias("lo"), F.max("cls").over(column).alias("hi"), pivot.alias("p")).where("lo <> hi OR salt > 0")
    blocks = blocks.groupBy("gram", "salt", "cls").agg(F.min("n").alias("n"), F.min("pos").alias("pos"), *[F.min(f"p.{c}").alias(f"p_{c}") for c in ("cls", "n", "pos")])
    blocks = stage(blocks.select("*", F.col("cls").alias("comp"), F.col("p_cls").alias("p_comp")), "blocks")
    hot = blocks.where("salt > 0").drop("p_cls", "p_n", "p_pos", "p_comp")
    hot = stage(hot.join(F.broadcast(_columns(hot).drop("rows")), "gram"), "hot")  # 2**16 columns at most
    blocks = blocks.where("salt = 0").unionByName(hot).drop("salt")

    def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        a, b = (sets.select(F.col("cls").alias(x), F.col("grams").alias(f"grams_{x}")) for x in "ab")
        ends = pairs.select("a").distinct()  # only these sets are dealt a second time
        if pairs.count() <= BROADCAST_PAIRS:
            pairs, ends = F.broadcast(pairs), F.broadcast(ends)
        both = b.join(pairs, "b").join(a.join(ends, "a", "left_semi"), "a").select("a", "b", "grams_a", "grams_b")
        return stage(both.mapInArrow(_accepted(percent), "a bigint, b bigint"), "links")

    def classes(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()

    tried = stage(_stars(blocks, percent), "first")
    sets = _fetch(text, classes(tried).join(reps, "cls"), k)
    links = verified(tried, sets)

    # the rest: pairs across components, among rows with an entry that may be the first of a pair
    may = blocks.where(F.col("pos") <= F.col("n") - F.ceil(F.lit(percent) * F.col("n") * (1 + percent / 100.0) / (100 + percent) - 1e-9)).select("cls").distinct()
    salt = F.pmod("gram", F.lit(8))  # a long text has many entries

    def beyond(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``pairs`` that haven't been tried, and the sets of all rows tried by then."""
        low, high = F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")
        new = pairs.select("a", "b", low, high).join(tried.select(low, high).distinct(), ["low", "high"], "left_anti")
        new = stage(new.select("a", "b"), "rest")  # a stays the pivot: as b it would be a hot key
        return new, sets.unionByName(_fetch(text, classes(new).join(classes(tried), "cls", "left_anti").join(reps, "cls"), k))

    while True:
        label = components(links).withColumnsRenamed({"node": "cls"})
        live = may.join(label, "cls", "left").select("cls", F.coalesce("component", "cls").alias("comp"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(7).cast("bigint"))).alias("salt"))
        inside = stage(blocks.select("gram", "cls", "n", "pos", salt.alias("salt")).join(live, ["cls", "salt"]).drop("salt"), "inside")
        across = stage(inside.join(_columns(inside), "gram"), "across")
        large = across.where(F.col("rows") > BLOCK).select("cls").distinct().count()
        if not large:
            break
        more, sets = beyond(_stars(across, percent))
        found = verified(more, sets)
        tried, links, n = tried.unionByName(more), links.unionByName(found), found.count()
        if 50 * n < large:  # stars find little more: the product does the rest
            break
    rest, sets = beyond(_product(across, percent, shared))
    links = links.unionByName(verified(rest, sets))

    left, right = reps.select(F.col("cls").alias("a"), F.col("rep").alias("ra")), reps.select(F.col("cls").alias("b"), F.col("rep").alias("rb"))
    graph = components(links.join(left, "a").join(right, "b"), "ra", "rb")
    by_class = stage(reps.join(graph, reps.rep == graph.node, "left").select("cls", "copies", F.coalesce("component", "rep").alias("component_id")), "classes")
    # classes of more than 2**-16 of all rows, 2**16 of them at most, are broadcast: no other has a hot key
    many = F.col("copies") > (n_rows >> 16)
    empty, members = members.where("n = 0"), members.where("n > 0")
    found = members.join(F.broadcast(by_class.where(many)), "cls").unionByName(members.join(by_class.where(~many), "cls")).select("doc", "n", "component_id")
    alone = empty.select("doc", "n", F.col("doc").alias("component_id"))
    return found.unionByName(alone).select(F.col("doc").alias(id_col), F.col("n").cast("long").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` without near copies: of each component the rows with the smallest id stay, and every row without an id.

    Defined results: null and empty texts link with nothing and stay; repeated rows that share the smallest id all stay; very long texts are
    compared whole; an empty table gives an empty table; all columns stay as they are, whatever their names.
    """
    groups = link_components(docs, id_col=id_col, text_col=text_col, k=k, percent=percent)
    gone = groups.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("id")).distinct()
    return docs.alias("d").join(gone.alias("g"), F.col(f"d.`{id_col}`").try_cast("bigint") == F.col("g.id"), "left_anti")
