import random
import re

import pytest
from pyspark.sql import functions as F

from strata.llm.ngram_join import keep_one, link_components, overlap_bound


def brute(rows, percent=75):
    """{doc: (n, component)} by comparing all sets."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    by = {}
    for d, s in sets.items():
        by.setdefault(frozenset(s), []).append(d)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = sorted((find(a), find(b)))
        parent[b] = a

    held = {}
    for s, ds in by.items():
        for d in ds[1:] if s else []:
            join(ds[0], d)
        for g in s:
            held.setdefault(g, []).append(s)
    seen = set()
    for group in held.values():
        for i, a in enumerate(group):
            for b in group[:i]:
                if (a, b) not in seen and (both := len(a & b)) * 100 >= percent * len(a | b) and both:
                    join(by[a][0], by[b][0])
                seen.add((a, b))
    return {d: (len(s), find(d)) for d, s in sets.items()}


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).withColumns({"cls": F.lit("x"), "n": F.lit(1), "gram": F.lit(2)})
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in link_components(df, **kw).collect()}
    want = brute(rows)
    assert got == want, [(k, got.get(k), v) for k, v in want.items() if got.get(k) != v][:5]


@pytest.mark.parametrize(("heavy", "block"), [(0, 256), (1 << 18, 256), (0, 3)])
def test_matches_comparing_all_pairs(spark, heavy, block, monkeypatch):
    monkeypatch.setattr("strata.llm.ngram_join.BLOCK", block)
    rng = random.Random(heavy)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for group in range(25):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([3, 5, 8, 30, 120]))]
        if group % 3 == 0:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        for _ in range(rng.choice([1, 2, 3, 12])):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
            rows.append(" ".join(w).title() if rng.random() < 0.2 else "\n".join(w))
    rows += [None, "", " \t", "one two", "ONE two", "one two three", "a " * 30_000, "a " * 29_999, passage[0]]
    rng.shuffle(rows)
    check(spark, list(enumerate(rows, 10)), heavy=heavy, sample_share=2)


def test_drifting_families_whose_members_miss_their_pivot(spark, monkeypatch):
    """Chains of texts, each near the one before, behind columns of many rows: stars are repeated, and blocks multiplied."""
    monkeypatch.setattr("strata.llm.ngram_join.BLOCK", 4)
    rng = random.Random(8)
    rows = []
    for chain in range(4):
        w = [f"c{chain}w{i}" for i in range(60)]
        for step in range(40):
            at = rng.randrange(0, 54)
            w[at : at + 2] = [f"c{chain}s{step}a", f"c{chain}s{step}b"]
            rows.append(" ".join(w))
    rng.shuffle(rows)
    check(spark, list(enumerate(rows)), heavy=0, sample_share=2)


def test_real_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    check(spark, rows)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(4, "a b c d e f"), (4, "a b c d e f"), (None, "a b c d e f"), (None, "other"), (2, "A b c d e f"), (9, "x y")], "doc_id bigint, text string")
    got = sorted(map(tuple, link_components(df).collect()), key=repr)
    assert got == sorted([(4, 2, 2), (4, 2, 2), (None, 2, 2), (None, 1, None), (2, 2, 2), (9, 1, 9)], key=repr)
    assert sorted(r["doc_id"] for r in keep_one(df).where("doc_id IS NOT NULL").collect()) == [2, 9]
    assert link_components(df.limit(0)).count() == 0


def test_overlap_bound():
    for m in range(1, 60):
        for n in range(1, 60):
            o = overlap_bound(m, n, 75)
            assert 100 * o >= 75 * (m + n - o) and not 100 * (o - 1) >= 75 * (m + n - o + 1)
