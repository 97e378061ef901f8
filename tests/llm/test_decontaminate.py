import random
import re
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import decontaminate as dc

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))


def brute(docs, tests, window=10):
    """[(n_words, n_hit, items)] by comparing all windows."""
    held = {}
    for item, text in tests:
        w = words(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            held.setdefault(tuple(w[i : i + window]), set()).add(item)
    out = []
    for text in docs:
        w, hit, items = words(text), set(), set()
        for n in {len(x) for x in held}:
            for i in range(len(w) - n + 1):
                if found := held.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    items |= found
        out.append((len(w), len(hit), sorted(items, key=lambda v: v or "")))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "été", "naïve", "x1", "Zürich", "42", "дом", "of", "the"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [("q1", say(30)), ("q2", say(12)), ("q3", "only four words here"), (None, "two  words!"), ("q4", ""), ("q5", None), ("q6", "-- ?!"), ("q1", say(30)), ("q10", say(15))]
    items.append(("q2", items[0][1]))
    docs = [None, "", " .,;", "only FOUR\nwords, here", "two words", "only four words", say(400)]
    for _ in range(60):
        _, text = rng.choice(items)
        w = (text or "").split()
        k = rng.randrange(len(w) + 1)
        docs.append(f"{say(rng.randrange(30))}. {' , '.join(w[k : k + rng.randrange(8, 25)]).upper()}\n{say(rng.randrange(20))}")
    docs += [docs[-1]] * 20 + ["w" * 70000 + " only four words here " + "y" * 9, "a " * 5000, "a b " * 3000]
    return docs, items


@pytest.mark.parametrize(("shard", "block"), [(1 << 22, 1 << 20), (500, 1 << 20), (2000, 256)])
def test_search_equals_comparing_all_windows(spark, monkeypatch, shard, block):
    monkeypatch.setattr(dc, "BLOCK_BYTES", block)
    docs, items = corpus(shard + block)
    df = spark.createDataFrame([(k % 50 or None, t, 7, k) for k, t in enumerate(docs)], "doc_id int, text string, n_hit int, row int").repartition(3)
    tests = spark.createDataFrame(items, "item_id string, text string")
    got = {r["row"]: (r["n_words"], r["n_hit"], r["item_ids"]) for r in dc.search(df, tests, shard_bytes=shard).collect()}
    assert [got[k] for k in range(len(docs))] == brute(docs, items)
    kept = dc.decontaminate(df, tests, shard_bytes=shard)
    assert kept.columns == df.columns
    assert sorted(r["row"] for r in kept.collect()) == [k for k, (_, n, _) in enumerate(brute(docs, items)) if not n]
    for r in dc.search(df, tests, keep=["row"]).collect():
        assert sum(s["past"] - s["first"] for s in r["spans"]) == r["n_hit"]


def test_longest_matches(spark):
    docs, items = corpus(5)
    df = spark.createDataFrame([(k, t) for k, t in enumerate(docs)], "doc_id int, text string").repartition(4)
    got = {}
    for r in dc.longest_matches(df, spark.createDataFrame(items, "item_id string, text string"), shard_bytes=3000).collect():
        got.setdefault((r["item_id"], r["start"]), set()).add(r["n_words"])
        w = words(docs[int(r["doc_id"])])[r["doc_start"] : r["doc_start"] + r["n_words"]]
        assert any(w == words(t)[r["start"] : r["start"] + r["n_words"]] for i, t in items if i == r["item_id"])
    want = {}
    texts = [f" {' '.join(words(t))} " for t in docs]
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9)) if w else ():
            for n in range(len(w) - i, min(10, len(w)) - 1, -1):
                if any(f" {' '.join(w[i : i + n])} " in t for t in texts):
                    want[item, i] = max(n, want.get((item, i), 0))
                    break
    assert {k: max(v) for k, v in got.items()} == want and all(len(v) == 1 for v in got.values())


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], "doc_id int, text string"), spark.createDataFrame([(1, "some words")], "doc_id int, text string")
    no_items, items = spark.createDataFrame([], "item_id int, text string"), spark.createDataFrame([(1, "some words")], "item_id int, text string")
    assert dc.search(none, items).collect() == []
    assert [(r["n_words"], r["n_hit"]) for r in dc.search(some, no_items).collect()] == [(2, 0)]
    assert [(r["n_words"], r["n_hit"]) for r in dc.search(some, spark.createDataFrame([(1, " ")], "item_id int, text string")).collect()] == [(2, 0)]
    assert dc.decontaminate(some, items).collect() == [] and dc.longest_matches(some, no_items).collect() == []


def test_suffix_arrays_are_in_order():
    rng = np.random.default_rng(3)
    for n, vocabulary in [(0, 1), (1, 1), (50, 1), (300, 2), (2000, 50), (400, 60000)]:
        docs = [list(rng.integers(0, vocabulary, rng.integers(0, 40))) for _ in range(n // 20)] + [[0] * n, [0] * n]
        ids = np.array([x for d, doc in enumerate(docs) for x in [*(v + len(docs) for v in doc), d]])
        assert dc.suffix_array(ids).tolist() == sorted(range(len(ids)), key=lambda i: ids[i:].tolist())


def test_hashes_that_differ_in_their_last_bits_alone():
    vocab, ids = dc.numbered(np.array([9, 8, 9, 1 << 60, 8], np.uint64))
    assert vocab.tolist() == [8, 9, 1 << 60] and ids.tolist() == [1, 0, 1, 2, 0]


def test_query_reports_the_items(spark, tmp_path):
    text = "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([(0, f"Zero. {text}"), (1, None)], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(10, text), (9, text), (3, "other")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    from strata.llm.queries import QUERIES

    rows = {r["doc_id"]: r for r in QUERIES["op11_decontamination"](spark, str(tmp_path)).orderBy(F.col("doc_id")).collect()}
    assert (rows[0]["n_words"], rows[0]["n_hit"], rows[0]["n_items"], rows[0]["items_sha256"], rows[0]["contaminated"]) == (12, 11, 2, sha256(b"10,9").hexdigest(), True)
    assert (rows[1]["n_words"], rows[1]["n_items"], rows[1]["items_sha256"], rows[1]["contaminated"]) == (0, 0, sha256(b"").hexdigest(), False)
