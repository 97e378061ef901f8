import functools
import math
import random
import zlib
from hashlib import sha256

import pytest

from strata.llm import prefix_trie as pt
from strata.llm import turn_repair as tr


def order(rows):
    """Rows (conv_id, turn, role, text) of each conversation by turn, nulls first."""
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, role, text))
    return by


def brute_trie(rows):
    own = {c: [(r or "", t or "") for _, _, r, t in sorted(v, key=lambda x: x[:2])] for c, v in order(rows).items() if c is not None}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    nodes = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        kids = {q for q in below if len(q) == len(p) + 1}
        leaf = lambda q: not any(len(x) == len(q) + 1 and x[: len(q)] == q for x in below)
        ends = ",".join(map(str, sorted(c for c in members if len(full[c]) == len(p))))
        saved = sum((len(nodes[q]) - 1) * (len(q[-1][1]) if q else 0) for q in below)
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids), sum(map(leaf, below)), saved, sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(seed, n=120):
    rng = random.Random(seed)
    texts = ["Hi.", "", None, "Why?", "Because", "So be it!", "é ñ", "\n\t"]
    rows = []
    for c in [*range(n), 200, 203, 305, -7]:
        for turn in rng.sample(range(9), rng.randrange(1, 8)):
            rows.append((c, turn or None, rng.choice(["user", "assistant", "system", None, "user"]), rng.choice(texts[: rng.choice((2, 8))])))
    return rows


@pytest.mark.parametrize("shard", [1 << 17, 40, 1])
def test_trie_equals_grouping_all_prefixes(spark, shard):
    rows = conversations(shard) + [(c, 1, "user", "the same") for c in range(400, 500)]  # a third are copies
    rows += [(700, k, "user", str(k % 3)) for k in range(300)] + [(701, k, "user", str(k % 3)) for k in range(299)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id bigint, turn bigint, role string, text string, path int, base int").repartition(5)
    got = [tuple(r[c] for c in COLUMNS) for r in pt.prefix_trie(pt.rebuilt(df), shard_turns=shard, chunk=3).collect()]
    assert sorted(got, key=repr) == brute_trie(rows)


def test_trie_of_conversations_as_they_are(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"), (None, 0, "user", "a")]
    seqs = pt.sequences(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    got = sorted((r["depth"], r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"]) for r in pt.prefix_trie(seqs).collect())
    assert got == [(0, 1, 2, 1, 2), (1, 1, 2, 2, 2), (2, 1, 1, 0, 1), (2, 2, 1, 0, 1)]


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert pt.prefix_trie(pt.rebuilt(none)).collect() == [] and tr.repair_turns(tr.damage(none)).collect() == []


def test_roles_and_texts_are_told_apart(spark):
    rows = [(1, 0, "user", "2:ab"), (2, 0, "user2", ":ab")]
    assert pt.prefix_trie(pt.sequences(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))).count() == 3


def test_medians_first_is_balanced():
    tree = pt.TernaryTree()
    for g in pt.medians_first(1000):
        tree.insert([g], [1], 1, g, g)
    deepest, level = 0, [tree.next[0]]
    while level:
        deepest, level = deepest + 1, [x for at in level for x in (tree.low[at], tree.high[at]) if x >= 0]
    assert deepest == 10


def brute_repair(turns):
    """(cost, audit, repaired) by trying all edits, with at most three inserts in a row."""
    def fits(state, initial):
        return tr.KEEP.get((state, initial))

    @functools.cache
    def best(i, state, inserts):
        found = [(0, "", ())] if i == len(turns) and state in (0, 3) else []
        if inserts < 3:
            to = tr.TURN[state]
            c, a, out = best(i, to, inserts + 1)
            found.append((c + 5, "I" + a, (tr.ROLE[to] + ":", *out)))
        if i < len(turns):
            role, text, fault = turns[i]
            c, a, out = best(i + 1, state, 0)
            found.append((c + 2, "D" + a, out))
            if fault not in (1, 2):
                more, to = 5 * (fault == 3), tr.TURN[state]
                c, a, out = best(i + 1, to, 0)
                found.append((c + 1 + more, "R" + a, (f"{tr.ROLE[to]}:{text}", *out)))
                if (to := fits(state, role[:1])) is not None:
                    c, a, out = best(i + 1, to, 0)
                    found.append((c + more, "K" + a, (f"{role}:{text}", *out)))
        return min(found, key=lambda x: x[:2]) if found else (1 << 40, "", ())

    return best(0, 0, 0)


def brute_damage(rows):
    space = lambda v: " " if v is None else v
    out = {}
    for c, turn, role, text in rows:
        left = out.setdefault(c, [])
        role, text = space(role), space(text)
        d = zlib.crc32(f"{space(c)}:{space(turn)}".encode()) % 20
        text = "" if d == 1 else "".join(x for x in text if x not in ".!?") if d == 2 else text
        left.extend([(turn, "user" if d == 4 else role, text)] * (0 if d == 0 else 2 if d == 3 else 1))
    return {c: sorted(left, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, left in out.items()}


def brute_row(left):
    seen, turns = set(), []
    for _, role, text in left:
        bare = text.strip(" \t\n\x0b\f\r")
        fault = 1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0
        seen.add((role, text))
        turns.append((role, text, fault))
    cost, audit, out = brute_repair(turns)
    at = {t for t, _, _ in left if t is not None}
    gaps = max(at) - min(at) + 1 - len(at) if at else 0
    illegal = sum((a[0][:1], b[0][:1]) not in (("s", "u"), ("u", "a"), ("a", "u")) for a, b in zip(turns, turns[1:], strict=False))
    return (gaps, *(sum(t[2] == k for t in turns) for k in (1, 2, 3)), illegal, cost, audit, sha256("\n".join(out).encode()).hexdigest())


@pytest.mark.parametrize("settle", [1, 2, 5, 4096])
def test_repair_equals_trying_all_edits(spark, settle):
    rng = random.Random(settle)
    texts = ["Yes.", "No!", "", None, "Why", "Why?  ", " \t", "Say. more", "é…"]
    rows = [(rng.randrange(160) or None, rng.randrange(30) or None, rng.choice(["user", "assistant", "system", "user", "assistant", None, "", "admin", "sage"]), rng.choice(texts)) for _ in range(1200)]
    rows += [(1000, k, ("user", "assistant")[k % 2], f"Turn {k}.") for k in range(200)] + [(1001, k, "user", f"Turn {k}") for k in range(90)]
    rows.append((int(next(c for c in range(5000, 9999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)), 0, "user", "dropped."))
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "conv_id int, turn bigint, role string, text string, fault int, cost int").repartition(5)
    got = {r["conv_id"]: tuple(r)[1:] for r in tr.repair_turns(tr.damage(df), settle=settle).collect()}
    want = {c: brute_row(left) for c, left in brute_damage(rows).items()}
    assert got == want, [(k, got.get(k), v) for k, v in want.items() if got.get(k) != v][:3]


@pytest.mark.parametrize("prime", [tr._PRIME, 5, 1])
def test_edits_compare_as_strings_even_where_hashes_collide(prime):
    rng = random.Random(prime)
    edits = tr.Edits(base=3, prime=prime)
    text = {0: ""}
    for _ in range(400):
        parent, op = rng.choice([*text][-30:]), rng.choice("DKRI")
        text[edits.add(parent, op)] = text[parent] + op
    for _ in range(3000):
        x, y = rng.choice([*text]), rng.choice([*text])
        assert edits.less(x, y) == (text[x] < text[y])
        common = next((k for k, (a, b) in enumerate(zip(text[x], text[y], strict=False)) if a != b), min(len(text[x]), len(text[y])))
        assert edits.common(x, y) == common


def test_long_conversations_forget_what_is_settled():
    repair = tr.Repair(settle=64)
    for k in range(20000):
        repair.add(("user", "assistant")[k % 2], f"Turn {k}.", 0)
    assert len(repair.edits.up) < 2000 and len(repair.rows) < 100
    cost, audit, _ = repair.done()
    assert (cost, audit) == (0, "K" * 20000)
