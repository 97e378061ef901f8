import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp
from strata.functions.shared import stage
from strata.llm import mixing
from strata.llm.tokens import default_path
from tests.llm.test_ngram_join import brute
from tests.llm.test_text_operators import brute_lines

SF = "/root/testdata/sf0.001"


def kept_by_rules(text):
    """(kept, clean text) of the quality rules, line by line."""
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    from strata.llm.quality_rules import BOILERPLATE, SEPARATORS

    def fails(line):
        n = len(split(line))
        marks = len(re.findall(SEPARATORS, line))
        return n > 0 and (len(re.findall("[#*$%&<>]", line)) > 0.3 * n or len(re.findall("[!?]", line)) > 0.3 * max(n, 4) or (marks >= 3 and marks > 0.15 * n) or (n <= 40 and bool(re.search(BOILERPLATE, line))))

    w = split(text)
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    repeated = len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)})
    clean = "\n".join(x for x in text.split("\n") if not fails(x))
    chars = len("".join(w))
    return not (len(w) < 20 or 100 * repeated > 30 * len(w)) and chars - len("".join(split(clean))) <= 0.5 * chars, clean


def test_each_stage_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(cp.COLUMNS)
    want = {r["doc_id"]: r["text"] for r in docs.collect()}
    made = {}
    for name, f in cp.STAGES[:-1]:
        docs = stage(f(spark, docs, SF), "test")
        assert docs.columns == cp.COLUMNS
        made[name] = docs.collect()
    want = {d: c for d, t in want.items() for ok, c in [kept_by_rules(t or "")] if ok}
    assert {r["doc_id"]: r["text"] for r in made["quality_rules"]} == want
    want = brute_lines(list(want.items()))
    assert {r["doc_id"]: r["text"] for r in made["line_dedup"]} == want
    assert all(r["n_chars"] == len(r["text"]) for r in made["line_dedup"])
    groups = brute(list(want.items()))
    want = {d: t for d, t in want.items() if groups[d][1] == d}
    assert {r["doc_id"]: r["text"] for r in made["ngram_jaccard_join"]} == want
    mixed = mixing.mix_sources(spark.createDataFrame(list(want.items()), "doc_id bigint, text string"), mixing.label_domains(spark.read.parquet(f"{SF}/labels.parquet")), cp.TARGETS, scale=cp.SCALE)
    copies = {r["doc_id"]: r["copies"] for r in mixed.collect()}
    got = [r["doc_id"] for r in made["mixing"]]
    assert {d: got.count(d) for d in want} == copies
    pieces = cp.STAGES[-1][1](spark, docs, SF).collect()
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_path("word_bpe_49k.json"))
    import zlib

    sums = {}
    for d, e in zip(want, t.encode_batch(list(want.values()), add_special_tokens=False), strict=True):
        ids = np.array([*e.ids, 0], "<u4")
        for k in range(0, len(ids), 2048):
            sums[d, k // 2048] = (min(2048, len(ids) - k), zlib.crc32(ids[k : k + 2048].tobytes()))
    assert sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in pieces) == sorted((d, p, *s) for (d, p), s in sums.items() for _ in range(copies[d]))
    at = {}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at.get(r["sequence_id"], 0)
        at[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(at.values()) <= 2048


def test_run_gives_the_last_stage(spark):
    got = cp.run(spark, SF)
    assert set(got.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    assert got.agg(F.count("*")).first()[0] > 0 and [n for n, _ in cp.STAGES] == ["quality_rules", "line_dedup", "ngram_jaccard_join", "mixing", "best_fit_packing"]
