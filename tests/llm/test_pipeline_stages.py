"""The mixing stage against plain Python, and odd rows through every stage."""

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp

SF = "/root/testdata/sf0.001"


def features(text):
    words = re.findall(r"[^\x00-/:-`{-\x7f]+", text.lower())
    share = lambda count, n: str(math.floor(min(10 * count / max(n, 1), 6)))
    shape = {
        "#symbols " + share(len(re.findall(r"[#*$%&|<>]", text)), len(words)), "#marks " + share(len(re.findall("[!?]", text)), len(words)),
        "#capitals " + share(len(re.findall("[A-Z]", text)), len(text)), "#distinct " + share(len(set(words)), len(words)),
    }
    return len(words), set(words) | shape


def plain_posteriors(texts, labels, domains):
    """(tokens, posteriors to three places) of texts, by sets of words, learnt from the labels."""
    found = {d: features(t) for d, t in texts.items()}
    own = {k: [found[d][1] for d, x in labels.items() if x == k and d in found] for k in domains}
    size = {k: len(v) for k, v in own.items()}
    n = {k: Counter(f for x in own[k] for f in x) for k in domains}
    both = sum(n.values(), Counter())
    odds, base = {}, np.array([math.log((size[k] + 1) / (sum(size.values()) + len(domains))) for k in domains])
    for f, count in both.items():
        tells = False
        for k in domains:
            e = count * size[k] / sum(size.values())
            beyond = n[k][f] * math.log(n[k][f] / e) - n[k][f] + e if n[k][f] else 0
            tells |= n[k][f] - e >= 3 * math.sqrt(e + 1) and n[k][f] >= 2.5 * e and beyond >= math.log(len(domains) * len(both) / 10)
        if tells:
            p = np.array([(n[k][f] + 1) / (size[k] + 2) for k in domains])
            odds[f] = np.log(p / (1 - p))
            base += np.log(1 - p)
    logits = np.array([base + sum((odds[f] for f in sorted(x & set(odds))), np.zeros(len(domains))) for _, x in found.values()])
    e = np.exp(np.maximum(logits - logits.max(1, keepdims=True), -30))
    return np.array([c for c, _ in found.values()]), np.floor(1000 * e / e.sum(1, keepdims=True) + 0.5) / 1000


def plain_calibrated(texts, labels, held, domains):
    """(tokens, posteriors) after what the held labels teach about the tokens that the other labels' posteriors give to each domain."""
    tokens, p = plain_posteriors(texts, labels, domains)
    n, q = plain_posteriors(texts, {d: x for d, x in labels.items() if d not in held}, domains)
    at = [(i, domains.index(labels[d])) for i, d in enumerate(texts) if d in held and labels.get(d) in domains]
    matrix = 20 * np.mean([n[i] for i, _ in at]) * np.eye(len(domains))
    for i, k in at:
        matrix[:, k] += n[i] * q[i]
    return tokens, np.floor(1000 * (p @ (matrix / matrix.sum(1, keepdims=True))) + 0.5) / 1000


def plain_rates(tokens, p, shares, scale, pull=1e-3):
    target, curve, rate = np.array(shares) / sum(shares) * scale * tokens.sum(), (tokens[:, None] * p * p).sum(0), np.ones(len(p))
    for _ in range(20_000):
        rate = np.maximum(0, rate - (p @ (((rate * tokens) @ p - target) / curve) + pull * (rate - 1)) / (len(shares) + pull))
    return rate


def test_mixing_stage_matches_plain_python(spark):
    sf = "/root/testdata/sf0.01"  # of fewer labels nothing is marked
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(cp.COLUMNS)
    labels = {}
    for r in spark.read.parquet(f"{sf}/labels.parquet").collect():
        labels[r["doc_id"]] = "toxic" if r["toxic"] == 1 else {1: "clean", 0: "low"}.get(r["quality"])
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    held = {r["doc_id"] for r in docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) % 4 == 3).select("doc_id").collect()}
    tokens, p = plain_calibrated(texts, labels, held, list(cp.TARGETS))
    rates = plain_rates(tokens, p, list(cp.TARGETS.values()), cp.SCALE)
    got = Counter(r["doc_id"] for r in cp.mix(spark, docs, sf).collect())
    chance = {r["doc_id"]: r["c"] for r in docs.select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit(42)), F.lit(1 << 30)) / float(1 << 30)).alias("c")).collect()}
    near = 0
    for d, rate in zip(texts, rates, strict=True):
        low, high = (math.floor(r) + (chance[d] < r - math.floor(r)) for r in (max(0.0, rate - 0.005), rate + 0.005))
        near += low != high
        assert low <= got[d] <= high, (d, rate, got[d])
    assert near < 0.03 * len(texts)
    assert len(set(rates.round(3))) > 1  # the stage tells documents apart
    assert set(got) <= set(texts)


def test_stages_take_odd_rows(spark):
    text = "\n".join(" ".join(f"plain{i}x{j}" for i in range(12)) + "." for j in range(4))
    long = " ".join(f"word{i}" for i in range(30_000))
    rows = [(1, text), (1, text), (2, None), (3, ""), (4, long), (None, text), (5, "short text"), (6, text)]
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for c in ("copies", "rate", "kept", "clean_text", "n_tokens", "posterior", "component_id", "n_lines", "figures"):
        docs = docs.withColumn(c, F.lit("old"))
    order = lambda rows: sorted(rows, key=lambda x: (x[0] is None, x[0] or 0, x[1] or ""))
    run = lambda f, docs=docs: f(spark, docs, SF)
    pairs = lambda df: order((r["doc_id"], r["text"]) for r in df.collect())

    clean = run(cp.clean_lines)
    assert clean.columns == cp.COLUMNS and pairs(clean) == order(x for x in rows if x[1] in (text, long))
    lines = run(cp.drop_repeated_lines)
    assert lines.columns == cp.COLUMNS and pairs(lines) == order((d, t or "") for d, t in rows)
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())
    copies = run(cp.drop_near_copies)
    assert copies.columns == cp.COLUMNS and pairs(copies) == order(x for x in rows if x[0] != 6)
    mixed = run(cp.mix)
    got = Counter(pairs(mixed))
    assert mixed.columns == cp.COLUMNS and set(got) <= set(rows) and got[1, text] % 2 == 0
    packed = run(cp.pack).collect()
    n = {d: sorted(r["length"] for r in packed if r["doc_id"] == d) for d, _ in rows}
    assert n[2] == n[3] == [1] and len(n[1]) == 2 and n[1][:1] == n[6] == n[None]
    assert len(n[4]) > 20 and set(n[4][1:]) == {2048}
    for _, f in cp.STAGES:
        assert run(f, docs.limit(0)).count() == 0
