"""Components by contraction, merge chains, and groups kept from day to day."""

import random

import pytest

from strata.functions import graph
from strata.operators import history, identity


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    assert dict(rows(graph.components(spark.createDataFrame(edges, "a bigint, b bigint")))) == brute(edges)


def test_rows_of_each_pass_fall(spark, monkeypatch):
    edges = [(i, i + 1) for i in range(500)] + [(9999, i) for i in range(600, 900)] + [(2000, 2001)]
    sizes, stage = {}, graph.stage

    def counted(df, name):
        out = stage(df, name)
        sizes.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(graph, "stage", counted)
    assert dict(rows(graph.components(spark.createDataFrame(edges, "a bigint, b bigint")))) == brute(edges)
    for name in ("edges", "chosen"):
        assert all(b < a for a, b in zip(sizes[name], sizes[name][1:], strict=False)), sizes
    assert sum(sizes["edges"]) < 3 * len(edges) and len(sizes["chosen"]) < 15


def test_merges_of_chains_trees_and_cycles(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(1, 300)] + [(1000 + i, rng.randrange(300)) for i in range(200)] + [(2001, 2002), (2002, 2003), (2003, 2001)] + [(2100 + i, 2101 + i) for i in range(50)] + [(2150, 2002)]
    win = dict(pairs)

    def walk(x):
        seen = []
        while x in win and x not in seen:
            seen.append(x)
            x = win[x]
        if x in seen:
            return min(seen[seen.index(x) :]), None
        return x, len(seen) - 1

    got = {r["loser"]: (r["root"], r["hops"]) for r in history.merge_map(spark.createDataFrame(pairs, "l bigint, w bigint"), "l", "w").collect()}
    assert got == {x: walk(x) for x in win}


def test_days_of_identities_equal_the_full_run(spark):
    rng = random.Random(4)
    days = [[(f"n{rng.randrange(60):02d}", rng.choice([f"e{rng.randrange(70)}", None, "hub"])) for _ in range(25)] for _ in range(4)]
    days.append([("n00", f"w{k}") for k in range(12)] + [(f"m{k}", "e1") for k in range(6)])  # too wide now: groups fall apart
    frame = lambda e: spark.createDataFrame(e, "hash string, email string")
    done, groups = days[0], identity.identity_groups(frame(days[0]))
    for day in days[1:]:
        groups = spark.createDataFrame(identity.update_groups(groups, frame(done), frame(day)).collect(), "node string, group_key string")
        done = done + day
        assert rows(groups) == rows(identity.identity_groups(frame(done)))
    assert rows(identity.update_groups(groups, frame(done), frame([]))) == rows(groups)
