"""Benchmark decontamination: suffix arrays over shards of the training text, binary-searched for the suffixes of all test items.

A shard is a run of whole documents of a task, about SHARD_BYTES of text. Its words become numbers in the order of their 64-bit hashes, each
document ends in a separator of its own, and the suffix array is sorted by doubling over word numbers, redone only where suffixes still tie.
A test suffix is found by binary search; the suffixes that begin with its first WINDOW words are one range of the array, which gives all
places of that window, and the neighbours of the suffix's own place give its longest verbatim match. No document is shuffled. Two words
of a shard and a test with equal hashes would be taken for one: the odds are about (words of both) / 2**64 for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.shared import stage
from strata.llm.tokens import slices

WINDOW = 10
#: Bytes of text in a shard; a longer document is a shard of its own.
SHARD_BYTES = 1 << 22
#: Bytes of test text that are broadcast at once; more is searched block by block.
BLOCK_BYTES = 1 << 20

# bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F], with A-Z lower-cased; all bytes of characters beyond ASCII are in words
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[65:91] = _IS_WORD[128:] = True
_VALUE = np.random.default_rng(10).integers(0, 1 << 63, 256).astype(np.uint64)[_LOWER] * np.uint64(2) + np.uint64(1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _chunks(is_word: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches of about ``most`` bytes that end outside a word."""
    at, n = 0, len(is_word)
    while at < n:
        end = min(at + most, n)
        if end < n:
            outside = np.flatnonzero(~is_word[at:end])
            if len(outside):
                end = at + int(outside[-1]) + 1
            else:
                ahead = np.flatnonzero(~is_word[end:])
                end = end + int(ahead[0]) + 1 if len(ahead) else n
        yield at, end
        at = end


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of each text's first word and, last, their number) of texts that lie end to end in ``data``."""
    is_word = _IS_WORD[data]
    begins = is_word.copy()
    begins[1:] &= ~is_word[:-1]
    edge = offsets[offsets < len(data)]
    begins[edge] = is_word[edge]
    count = np.concatenate([[0], np.cumsum(begins, dtype=np.int64)])
    hashes = []
    for at, end in _chunks(is_word, SHARD_BYTES):
        inside = is_word[at:end]
        value = data[at:end][inside]
        first = np.flatnonzero(begins[at:end][inside])
        if not len(first):
            continue
        length = np.diff(first, append=len(value))
        place = np.arange(len(value), dtype=np.int32) - np.repeat(first.astype(np.int32), length)
        power = np.cumprod(np.full(int(length.max()), _FACTOR, np.uint64))
        h = np.add.reduceat(_VALUE[value] * power[place], first)
        hashes.append((h ^ (h >> np.uint64(29))) * _FACTOR)
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), count[offsets]


def _sorted_with_place(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, sorted key) of keys of at most ``bits`` bits."""
    place = max(1, len(key).bit_length())
    if bits + place > 64:
        order = np.argsort(key, kind="stable")
        return order, key[order]
    both = np.sort(key.astype(np.uint64) << np.uint64(place) | np.arange(len(key), dtype=np.uint64))
    return (both & np.uint64((1 << place) - 1)).astype(np.int64), both >> np.uint64(place)


def numbered(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct hashes in order, number of each word)."""
    place = max(1, len(hashes).bit_length())
    order, _ = _sorted_with_place(hashes >> np.uint64(place), 64 - place)
    by = hashes[order]
    new = np.ones(len(by), bool)
    new[1:] = by[1:] != by[:-1]
    if (by[1:] < by[:-1]).any():  # hashes that differ in their last bits alone
        return np.unique(hashes, return_inverse=True)
    ids = np.empty(len(by), np.int64)
    ids[order] = np.cumsum(new) - 1
    return by[new], ids


def suffix_array(ids: np.ndarray) -> np.ndarray:
    """Places of all suffixes of ``ids`` in order. Equal stretches must end in values that differ, as separators do."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.int64)
    bits, place = int(ids.max()).bit_length() or 1, max(1, n.bit_length())
    depth = max(1, (64 - place) // bits)
    padded = np.concatenate([ids, np.zeros(depth, ids.dtype)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(depth):
        key = key << np.uint64(bits) | padded[k : k + n]
    sa, key = _sorted_with_place(key, depth * bits)
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    slot = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[sa] = head = np.maximum.accumulate(np.where(new, slot, 0))
    while True:
        tied = np.flatnonzero(~new | ~np.append(new[1:], True))
        if not len(tied):
            return sa
        at, group = sa[tied], head[tied]
        after = np.where(at + depth < n, rank[np.minimum(at + depth, n - 1)] + 1, 0)
        if 2 * place + len(tied).bit_length() <= 64:
            order, key = _sorted_with_place(group.astype(np.uint64) << np.uint64(place) | after.astype(np.uint64), 2 * place)
        else:
            order = np.lexsort((after, group))
            key = group[order].astype(np.uint64) << np.uint64(32) | after[order].astype(np.uint64)
        at = at[order]
        sa[tied] = at
        fresh = np.ones(len(tied), bool)
        fresh[1:] = key[1:] != key[:-1]
        new[tied] = fresh
        head[tied] = np.maximum.accumulate(np.where(fresh, tied, 0))
        rank[at] = head[tied]
        depth *= 2


class Shard(NamedTuple):
    """Whole texts, end to end: ``ids`` are separators 0, 1, ... (one after each text) and, above them, numbers of words in ``vocab``."""

    vocab: np.ndarray
    ids: np.ndarray
    sa: np.ndarray
    starts: np.ndarray  # place of each text's first word, and last of all the end


def shard_of(texts) -> Shard:
    """The shard of an Arrow array of texts."""
    hashes, first = words_of(*_bytes(texts))
    vocab, words = numbered(hashes)
    n = len(first) - 1
    starts = first + np.arange(n + 1)
    ids = np.empty(starts[-1], np.int64)
    ends = np.zeros(len(ids), bool)
    ends[starts[1:] - 1] = True
    ids[ends], ids[~ends] = np.arange(n), words + n
    return Shard(vocab, ids, suffix_array(ids), starts)


def _bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


class Tests(NamedTuple):
    """Test items, cut into their suffixes."""

    words: np.ndarray  # hashes of all words, items end to end
    starts: np.ndarray  # of suffixes that hold a whole window
    widths: np.ndarray  # of those windows: WINDOW, or the words of an item that has fewer
    ends: np.ndarray  # where the item ends
    owners: list  # (item, index of its first word) of each suffix
    windows: np.ndarray  # index of a suffix for each distinct window
    owned: list  # items that hold each distinct window


def tests_of(items: Sequence[tuple], window: int) -> Tests:
    """The suffixes of (item, index of its first word, text)."""
    import pyarrow as pa

    hashes, first = words_of(*_bytes(pa.array([x[2] for x in items], pa.string())))
    starts, widths, ends, owners, by = [], [], [], [], {}
    for (item, at, _), begin, end in zip(items, first[:-1].tolist(), first[1:].tolist(), strict=True):
        w = min(window, end - begin)
        for p in range(begin, end - w + 1) if w else ():
            by.setdefault(hashes[p : p + w].tobytes(), (len(starts), set()))[1].add(item)
            starts.append(p)
            widths.append(w)
            ends.append(end)
            owners.append((item, at + p - begin))
    return Tests(hashes, *(np.array(x, np.int64) for x in (starts, widths, ends)), owners, np.array([i for i, _ in by.values()], np.int64), [sorted(x, key=lambda v: v or "") for _, x in by.values()])


def _common(ids, at, words, of, most) -> np.ndarray:
    """How many words the suffixes at ``at`` share with the test suffixes ``of``, up to ``most``."""
    n, left = np.zeros(len(at), np.int64), np.flatnonzero(most > 0)
    while len(left):
        left = left[ids[at[left] + n[left]] == words[of[left] + n[left]]]
        n[left] += 1
        left = left[n[left] < most[left]]
    return n


def _bound(shard: Shard, words, of, most, *, above: bool) -> np.ndarray:
    """By binary search, how many suffixes of the shard come before the first ``most`` words of each test suffix; ``above``: or begin with them."""
    low, high = np.zeros(len(of), np.int64), np.full(len(of), len(shard.sa), np.int64)
    while len(k := np.flatnonzero(low < high)):
        mid = (low[k] + high[k]) // 2
        at, n = shard.sa[mid], _common(shard.ids, shard.sa[mid], words, of[k], most[k])
        whole = n == most[k]
        j = np.where(whole, 0, n)
        right = np.where(whole, above, shard.ids[at + j] < words[of[k] + j])
        low[k], high[k] = np.where(right, mid + 1, low[k]), np.where(right, high[k], mid)
    return low


def _in_shard(shard: Shard, tests: Tests) -> np.ndarray:
    """The tests' words as the shard's numbers; -1 where it hasn't the word."""
    if not len(shard.vocab):
        return np.full(len(tests.words), -1)
    at = np.minimum(np.searchsorted(shard.vocab, tests.words), len(shard.vocab) - 1)
    return np.where(shard.vocab[at] == tests.words, at + len(shard.starts) - 1, -1)


def _likely(words: np.ndarray, tests: Tests, which: np.ndarray) -> np.ndarray:
    """Those of the suffixes ``which`` whose window's words the shard has all."""
    missing = np.concatenate([[0], np.cumsum(words < 0)])
    return which[missing[tests.starts[which] + tests.widths[which]] == missing[tests.starts[which]]]


def hits(shard: Shard, tests: Tests) -> list[tuple[int, int, list, list]]:
    """(text, words hit, items, stretches of hit words) of each text that holds a window."""
    words = _in_shard(shard, tests)
    number = np.full(len(tests.starts), -1)
    number[tests.windows] = np.arange(len(tests.windows))
    which = _likely(words, tests, tests.windows)
    of, width = tests.starts[which], tests.widths[which]
    low, high = _bound(shard, words, of, width, above=False), _bound(shard, words, of, width, above=True)
    n = high - low
    if not n.sum():
        return []
    at = shard.sa[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
    size = len(shard.ids) + 1
    change = np.bincount(at, minlength=size) - np.bincount(at + np.repeat(width, n), minlength=size)
    hit = np.cumsum(change[:-1]) > 0
    edge = np.flatnonzero(np.diff(hit, prepend=False, append=False)).reshape(-1, 2)  # no stretch goes past a text's separator
    text_of = lambda places: np.searchsorted(shard.starts, places, side="right") - 1
    stretches, pairs = {}, np.unique(text_of(at) * len(tests.windows) + np.repeat(number[which], n))
    for doc, (a, b) in zip(text_of(edge[:, 0]).tolist(), edge.tolist(), strict=True):
        stretches.setdefault(doc, []).append((a - int(shard.starts[doc]), b - int(shard.starts[doc])))
    items = {}
    for doc, window in zip((pairs // len(tests.windows)).tolist(), (pairs % len(tests.windows)).tolist(), strict=True):
        items.setdefault(doc, set()).update(tests.owned[window])
    return [(doc, sum(b - a for a, b in found), sorted(items[doc], key=lambda v: v or ""), found) for doc, found in stretches.items()]


def longest(shard: Shard, tests: Tests) -> list[tuple]:
    """(item, index of the suffix's first word, words, text, index of the word there) of each test suffix whose window the shard holds: its longest match."""
    words = _in_shard(shard, tests)
    which = _likely(words, tests, np.arange(len(tests.starts)))
    of, whole = tests.starts[which], tests.ends[which] - tests.starts[which]
    place = _bound(shard, words, of, whole, above=False)
    near = np.stack([np.maximum(place - 1, 0), np.minimum(place, len(shard.sa) - 1)])
    n = np.stack([_common(shard.ids, shard.sa[x], words, of, whole) for x in near]) if len(which) else np.zeros((2, 0), np.int64)
    best = n.argmax(axis=0)
    n, at = n.max(axis=0), shard.sa[np.take_along_axis(near, best[None], 0)[0]] if len(which) else of
    found = np.flatnonzero(n >= tests.widths[which])
    docs = np.searchsorted(shard.starts, at[found], side="right") - 1
    return [(*tests.owners[which[k]], int(n[k]), int(d), int(at[k] - shard.starts[d])) for k, d in zip(found.tolist(), docs.tolist(), strict=True)]


def _pieces(most: int, window: int):
    """Items of over ``most`` bytes as pieces that share window - 1 words, so that each window lies in a piece."""
    def run(batches: Iterator) -> Iterator:
        import re

        import pyarrow as pa

        word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
        for b in batches:
            out = []
            for item, text in zip(b["item"].to_pylist(), b["text"].to_pylist(), strict=True):
                text = text or ""
                if len(text) <= most // 4:
                    out.append((item, 0, text))
                    continue
                spans = [m.span() for m in word.finditer(text)]
                begin = 0
                while begin < len(spans):
                    end = begin
                    while end < len(spans) and (end - begin < window or spans[end][1] - spans[begin][0] <= most // 4):
                        end += 1
                    out.append((item, begin, text[spans[begin][0] : spans[end - 1][1]]))
                    begin = len(spans) if end == len(spans) else end - window + 1
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.string()), strict=True)] if out else [pa.array([], t) for t in (pa.string(), pa.int64(), pa.string())], names=["item", "at", "text"])

    return run


def _blocks(tests: DataFrame, text_col: str, id_col: str, window: int) -> Iterator[Tests]:
    """The test items in blocks of at most about BLOCK_BYTES, one at a time on the driver; no block for a table without words."""
    items = tests.select(F.col(f"`{id_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").alias("text")).distinct()
    items = items.mapInArrow(_pieces(BLOCK_BYTES // 8, window), "item string, at bigint, text string")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size <= BLOCK_BYTES:
        parts = [items]
    else:
        k = -(-2 * size // BLOCK_BYTES)
        items = stage(items.withColumn("block", F.pmod(F.xxhash64("item", "at", "text"), F.lit(k))), "test-items")
        parts = [items.where(F.col("block") == i) for i in range(k)]
    for p in parts:
        found = tests_of([tuple(r) for r in p.select("item", "at", "text").collect()], window)
        if len(found.starts):
            yield found


_FOUND = "n_words bigint, n_hit bigint, item_ids array<string>, spans array<struct<first:bigint,past:bigint>>"


def _results(n: int, found: list, n_words: np.ndarray) -> list:
    import pyarrow as pa

    hit, items, spans = np.zeros(n, np.int64), [[]] * n, [[]] * n
    for doc, m, ids, stretches in found:
        hit[doc], items[doc], spans[doc] = m, ids, [{"first": a, "past": b} for a, b in stretches]
    return [pa.array(n_words), pa.array(hit), pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())])))]


def _shards(batches: Iterator, most: int) -> Iterator:
    for b in slices(batches, "text", most):
        yield b, shard_of(b["text"])


def _searched(tests, most: int):
    """Whole documents in, and out with what was found: shards live as long as it takes to search them."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b, shard in _shards(batches, most):
            kept = [k for k, name in enumerate(b.schema.names) if name != "text"]
            found = _results(b.num_rows, hits(shard, tests.value) if tests else [], np.diff(shard.starts) - 1)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), *found], names=[*(b.schema.names[k] for k in kept), "n_words", "n_hit", "item_ids", "spans"])

    return run


_ARRAYS = "rows array<bigint>, starts binary, vocab binary, ids binary, sa binary"


def _built(most: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b, s in _shards(batches, most):
            yield pa.RecordBatch.from_arrays([pa.array([b["row"].to_pylist()], pa.list_(pa.int64())), *(pa.array([x.tobytes()], pa.binary()) for x in (s.starts, s.vocab, s.ids.astype(np.int32), s.sa.astype(np.int32)))], names=["rows", "starts", "vocab", "ids", "sa"])

    return run


def suffix_arrays(docs: DataFrame, row: str, text_col: str = "text", *, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The shards as rows (rows, starts, vocab, ids, sa), to be written once and searched for many tests; ``row`` numbers the documents."""
    return docs.select(F.col(row).alias("row"), F.col(f"`{text_col}`").alias("text")).mapInArrow(_built(shard_bytes), _ARRAYS)


def _read(b) -> Iterator[tuple[list, Shard]]:
    for k in range(b.num_rows):
        starts, vocab, ids, sa = (np.frombuffer(b[c][k].as_buffer(), t) for c, t in (("starts", np.int64), ("vocab", np.uint64), ("ids", np.int32), ("sa", np.int32)))
        yield b["rows"][k].as_py(), Shard(vocab, ids.astype(np.int64), sa.astype(np.int64), starts)


def search(docs: DataFrame, tests: DataFrame, *, text_col: str = "text", test_col: str = "text", id_col: str = "item_id", keep: Sequence[str] | None = None, window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` (its columns ``keep``, or all but the text) with n_words, n_hit (words inside a test window), item_ids and spans of hit words.

    A window is ``window`` consecutive words of an item, or all words of one that has fewer. One job, without a shuffle, for up to BLOCK_BYTES of
    tests; beyond, the suffix arrays are staged and searched block by block, so neither driver nor executors hold more than a block.

    Defined results: null and empty texts have no words and hit nothing, in either table; rows that repeat, null ids and ties count as rows of
    their own; items with the same id count once, a null item id is listed as null; an empty table of tests hits nothing, an empty table of
    documents gives an empty table; very long texts are read whole; columns named like the results give way to them.
    """
    names = [c for c in (keep if keep is not None else [c for c in docs.columns if c != text_col]) if c.lower() not in ("n_words", "n_hit", "item_ids", "spans")]
    inner = [f"c{k}" for k in range(len(names))]
    rows = docs.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(names, inner, strict=True)], F.col(f"`{text_col}`").alias("text"))
    schema = ", ".join([*(f"{k} {rows.schema[k].dataType.simpleString()}" for k in inner), _FOUND])
    back = [*[F.col(k).alias(c) for c, k in zip(names, inner, strict=True)], "n_words", "n_hit", "item_ids", "spans"]
    share = docs.sparkSession.sparkContext.broadcast
    blocks = _blocks(tests, test_col, id_col, window)
    first, second = next(blocks, None), next(blocks, None)
    if second is None:
        return rows.mapInArrow(_searched(share(first) if first else None, shard_bytes), schema).select(back)
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "documents")
    arrays = stage(suffix_arrays(rows, "row", shard_bytes=shard_bytes), "suffix-arrays")
    found = None
    for block in (x for part in ((first, second), blocks) for x in part):
        shared = share(block)
        now = stage(arrays.mapInArrow(_hits_of(shared, found is None), f"row bigint, {_FOUND}"), "hits")
        shared.unpersist()
        found = now if found is None else found.unionByName(now)
    ordered = F.array_sort(F.flatten(F.collect_list("spans")))
    found = found.groupBy("row").agg(F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"), _joined(ordered).alias("spans"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["past"] - s["first"]).alias("n_hit")
    return rows.drop("text").join(found, "row").withColumn("n_hit", n_hit).select(back)


def _hits_of(tests, first: bool):
    """(row, n_words, n_hit, item_ids, spans) of rows that a block hits; of all rows for the first block."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for rows, shard in _read(b):
                found = hits(shard, tests.value)
                of = list(range(len(rows))) if first else [x[0] for x in found]
                columns = _results(len(rows), found, np.diff(shard.starts) - 1)
                yield pa.RecordBatch.from_arrays([pa.array([rows[k] for k in of], pa.int64()), *(c.take(pa.array(of, pa.int64())) for c in columns)], names=["row", "n_words", "n_hit", "item_ids", "spans"])

    return run


def _joined(spans):
    """Sorted stretches, with those that overlap or touch made one."""
    def add(done, s):
        last = F.element_at(done, -1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["past"], s["past"]).alias("past"))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["past"] >= s["first"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(spans, F.array().cast("array<struct<first:bigint,past:bigint>>"), add)


def decontaminate(docs: DataFrame, tests: DataFrame, *, text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` without a word that a test window covers; same columns. Odd rows as in search()."""
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), F.col(f"`{text_col}`").alias("text"))
    found = search(marked, tests, keep=["document"], **kw).where("n_hit = 0")
    return found.select(*[F.col("document").getField(c).alias(c) for c in docs.columns])


def longest_matches(docs: DataFrame, tests: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text", test_col: str = "text", id_col: str = "item_id", window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(item_id, start, n_words, doc_id, doc_start): for each word of an item with a window from there on, the longest verbatim match that begins there.

    Only suffixes whose window occurs have a row. Each shard gives one place; of those of equal length the one with the smallest id, as text, is
    taken. Items of over an eighth of BLOCK_BYTES are cut, and matches with them. Odd rows as in search(); a null doc_id comes after all others.
    """
    docs = docs.select(F.col(f"`{doc_col}`").cast("string").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    schema = "item_id string, start bigint, n_words bigint, doc_id string, doc_start bigint"

    def of(tests):
        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for b, shard in _shards(batches, shard_bytes):
                found = [(i, s, n, b["doc"][d].as_py(), p) for i, s, n, d, p in longest(shard, tests.value)]
                types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], t) for k, t in enumerate(types)], names=["item_id", "start", "n_words", "doc_id", "doc_start"])

        return run

    found = None
    for block in _blocks(tests, test_col, id_col, window):
        now = docs.mapInArrow(of(docs.sparkSession.sparkContext.broadcast(block)), schema)
        found = now if found is None else found.unionByName(now)
    if found is None:
        return docs.sparkSession.createDataFrame([], schema)
    best = F.min(F.struct((-F.col("n_words")).alias("less"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "doc_start")).alias("best")
    return found.groupBy("item_id", "start").agg(best).select("item_id", "start", (-F.col("best.less")).alias("n_words"), "best.doc_id", "best.doc_start")
