import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import fingerprints as fp
from strata.llm import language_id, mixing, quality_classifier, sharding
from strata.llm.line_dedup import LineRuns, dedup_lines
from strata.llm.quality_rules import quality_rules
from strata.llm.queries import QUERIES, oracle_sql
from tests.oracle import compare, connection

SF = "/root/testdata/sf0.001"


def frame(spark, texts, ids=None, **extra):
    rows = list(zip(ids or range(len(texts)), texts, strict=True))
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({k: F.lit(v) for k, v in extra.items()})


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_queries_match_their_sql(spark, name):
    compare(QUERIES[name](spark, SF), oracle_sql()[name], connection(SF))


# line dedup


def brute_lines(rows, least=5):
    key = lambda x: re.sub(r"[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for d, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= 40:
                held.setdefault(k, []).append(d)
    gone = {k: max(ds) for k, ds in held.items() if len(ds) >= least}
    return {d: "\n".join(x for x in (t or "").split("\n") if gone.get(key(x), d) == d) for d, t in rows}


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(3)
    pool = [("Línea común " * 5 + str(i)) if i % 2 else ("Common line " * 4 + str(i)) for i in range(12)] + ["short", "", " \t", "x" * 39, "y" * 40, "É" * 40, "é" * 40]
    texts = ["\n".join((rng.choice([str.upper, str, lambda s: " " + s + "\r"]))(rng.choice(pool)) for _ in range(rng.randint(0, 9))) for _ in range(80)] + [None, "", "z" * 300_000, pool[0]]
    df = frame(spark, texts, n_lines="clash", h1=1, last="x", row=3, at="y", doc=4, __doc=5)
    got = {r["doc_id"]: r for r in dedup_lines(df, batches=5).collect()}
    want = brute_lines(list(enumerate(texts)))
    assert {d: r["text"] for d, r in got.items()} == want
    for d, t in enumerate(texts):
        assert got[d]["n_lines"] == (t or "").count("\n") + 1
    assert dedup_lines(df.limit(0)).count() == 0


def test_runs_are_levelled_share_no_key_and_merge_without_a_shuffle(spark):
    runs = LineRuns(spark, 4)
    keys = [spark.createDataFrame([(i % 3, 0, i), (7, 0, i)], "h1 bigint, h2 bigint, doc bigint") for i in range(5)]
    assert runs.unseen(keys[0]).count() == 2
    for k in keys:
        runs.add(k)
    assert [x is not None for x in runs.levels] == [True, False, True] and [x is not None for x in runs.again] == [False, False, True]
    assert sorted(r["h1"] for x in runs.runs() for r in x.collect()) == [0, 1, 2, 7]
    assert runs.unseen(spark.createDataFrame([(7, 0), (8, 0)], "h1 bigint, h2 bigint")).collect()[0]["h1"] == 8
    assert [tuple(r) for r in runs.frequent(5).collect()] == [(7, 0, 5, 4)]
    a, b = runs.runs()
    for df in (runs.merged(a, b), runs.unseen(a)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    runs.close()
    assert not runs._paths


def test_line_dedup_is_linear_in_the_lines_that_go(spark):
    import time

    def took(n):
        text = "\n".join(f"a line that six documents share, number {i:08d}" for i in range(n))
        df = frame(spark, [text] * 6)
        began = time.time()
        assert [r["n_dropped"] for r in dedup_lines(df, batches=2).orderBy("doc_id").collect()] == [n] * 5 + [0]
        return time.time() - began

    took(500)
    assert took(24_000) < 8 * took(6_000)


def test_line_dedup_repeated_rows_and_null_ids(spark):
    x = "x" * 50
    rows = [(1, x), (1, x), (1, x + "\nmore"), (None, x), (None, None), (2, "y\n" + x + "\n" + x), (2, "z\n" + x)]
    got = sorted(((r["doc_id"], r["text"], r["n_dropped"]) for r in dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()), key=repr)
    assert got == sorted([(1, "", 1), (1, "", 1), (1, "more", 1), (None, "", 1), (None, "", 0), (2, "y\n" + x + "\n" + x, 0), (2, "z\n" + x, 0)], key=repr)


# quality rules


def test_quality_rules_by_case(spark):
    prose = "\n".join(" ".join(f"word{i}x{j}" for i in range(30)) + "." for j in range(4))
    cases = {
        "prose": (prose, True), "null": (None, False), "empty": ("", False), "short": ("only a few words", False), "menu": ("\n".join(["Home | About | Contact | Help"] * 8), False),
        "marks": (" ".join(f"W{i}!!" for i in range(60)), False), "symbols": (" ".join(f"w{i}***" for i in range(60)), False), "notice": (prose + "\nAll rights reserved.", True), "repeats": ("to be or not to be that is " * 20, False), "long": (prose * 800, False),
    }
    df = frame(spark, [t for t, _ in cases.values()], kept="clash", n_words="clash", figures="f", by_line=2, __f=1)
    got = {r["doc_id"]: r for r in quality_rules(df).collect()}
    for i, (name, (text, kept)) in enumerate(cases.items()):
        assert got[i]["kept"] == kept, name
    assert got[list(cases).index("notice")]["clean_text"] == prose
    assert got[0]["clean_text"] == prose and got[1]["n_words"] == 0
    assert quality_rules(df.limit(0)).count() == 0


def test_quality_rules_repeated_rows_and_null_ids(spark):
    t = " ".join(f"w{i}" for i in range(30)) + "\n" + "# " * 30
    got = [tuple(r) for r in quality_rules(spark.createDataFrame([(1, t), (1, t), (None, t)], "doc_id bigint, text string")).drop("doc_id", "text").collect()]
    assert len(got) == 3 and len(set(got)) == 1 and got[0][-1] == t.split("\n")[0]


def test_line_rules_find_planted_lines_in_each_language(spark):
    """Navigation, symbols and marks are no matter of language; of the notices, only those in English are known."""
    prose = {
        "de": "Der Zug nach Norden fährt heute etwas später ab, weil auf der Strecke gebaut wird.", "fr": "Le train du matin part un peu plus tard, parce que la voie est en travaux.",
        "es": "El tren de la mañana sale un poco más tarde, porque hay obras en la vía.", "en": "The morning train leaves a little later, since the line is being repaired.",
    }
    menus = {"de": "Start | Über uns | Kontakt | Impressum", "fr": "Accueil › Produits › Aide › Contact", "es": "Inicio · Noticias · Ayuda · Contacto", "en": "Home » About » Help » Contact"}
    planted = ["*** ### $$$ %%%", "!!! ??? !!!", "Copyright (c) 2020 Someone. All rights reserved."]
    langs = sorted(prose)
    texts = ["\n".join([prose[x]] * 3 + [menus[x], *planted] + [prose[x] + " " + str(i) for i in range(4)]) for x in langs]
    for x, r in zip(langs, quality_rules(frame(spark, texts)).orderBy("doc_id").collect(), strict=True):
        assert r["clean_text"].split("\n") == [prose[x]] * 3 + [prose[x] + " " + str(i) for i in range(4)], x


def test_repeated_words_match_brute_force(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(200)] + [" ".join(f"w{rng.randrange(40)}" for _ in range(900)) + " x y z" * 9]

    def brute(t):
        w = t.split()
        seen = {}
        for i in range(len(w) - 7):
            seen.setdefault(tuple(w[i : i + 8]), []).append(i)
        return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(8)})

    got = {r["doc_id"]: r["n_repeat_words"] for r in quality_rules(frame(spark, texts)).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


# language id


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language_id.fit(docs.where(~held))
    assert set(model) == {"en", "de", "fr", "es"} and all(len(m) <= 110_000 for m in model.values())
    got = language_id.identify(docs.where(held), model).join(docs.select("doc_id", "lang").withColumnRenamed("lang", "true"), "doc_id")
    right, n = got.agg(F.avg((F.col("nearest") == F.col("true")).cast("int")), F.count("*")).first()
    assert n > 300 and right > 0.93  # about 4 in 100 of the labels name another language than the text's
    odd = language_id.identify(frame(spark, [None, "", "123 !!", "a", "x" * 200_000], lang=1), model).orderBy("doc_id").collect()
    assert [r["nearest"] for r in odd[:3]] == ["und"] * 3 and odd[3]["nearest"] in model and odd[3]["rejected"]
    assert all(0 <= r["score"] <= 1 for r in odd)
    assert language_id.fit(docs.limit(0)) == {} and language_id.identify(docs.limit(0), model).count() == 0


def test_language_id_gets_long_texts_in_small_batches(spark, monkeypatch):
    """A batch of thousands of long texts would take an executor's memory, whatever is done with a row."""

    def sizes(*_):
        def run(batches):
            import pyarrow as pa

            for b in batches:
                n = b.num_rows
                yield pa.RecordBatch.from_arrays([b["id"], pa.nulls(n, pa.string()), pa.nulls(n, pa.string()), pa.array([float(b.nbytes)] * n), pa.array([True] * n)], names=["id", "lang", "nearest", "score", "rejected"])

        return run

    monkeypatch.setattr(language_id, "_predict", sizes)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        texts = spark.range(0, 200, 1, 1).select(F.col("id").alias("doc_id"), F.expr("repeat('ab ', 40000)").alias("text"))
        got = [r["score"] for r in language_id.identify(texts, {}).collect()]
        assert len(got) == 200 and max(got) < 3 << 20  # 24 MB in all
        spark.conf.set(key, "1m")  # a bound of the user's stays
        got = [r["score"] for r in language_id.identify(texts, {}).collect()]
        assert len(got) == 200 and max(got) < 3 << 19
    finally:
        spark.conf.set(key, before)


def test_language_id_matches_brute_force(spark):
    """Sizes of the whole text by each dictionary, one compressor after the other, chunk by chunk."""
    import math

    import zstandard as z

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs)
    texts = [r["text"] for r in docs.orderBy("doc_id").limit(60).collect()] + ["²", "½ 3", "Ⅳ ① ٣", "ª", "日本語のテキスト", "mot " * 5000, "Même chose, même ligne."]
    texts += texts[-2:]  # repeated rows
    got = {r["doc_id"]: r for r in language_id.identify(frame(spark, texts, lang="x", nearest="y", score=1), model).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        if not t or not any(c.isalpha() for c in t):
            assert (r["lang"], r["nearest"], r["score"], r["rejected"]) == (None, "und", 0.0, True), t
            continue
        sizes = {}
        for name in sorted(model):
            c = z.ZstdCompressor(level=3, dict_data=z.ZstdCompressionDict(model[name], dict_type=z.DICT_TYPE_RAWCONTENT), write_content_size=False, write_dict_id=False)
            raw = t.lower().encode()
            sizes[name] = sum(len(c.compress(raw[k : k + 4096])) for k in range(0, len(raw), 4096))
        best, second = sorted(sizes.values())[:2]
        nearest = min(sizes, key=lambda n: (sizes[n], n))
        assert r["nearest"] == nearest and r["rejected"] == (second - best < 0.01 * second) and r["lang"] == (None if r["rejected"] else nearest)
        assert abs(r["score"] - 1 / sum(math.exp((best - s) / max(1, 0.02 * best)) for s in sizes.values())) < 1e-9
    two = {"aa": b"same words here", "bb": b"same words here"}
    tie = language_id.identify(frame(spark, ["same words here"]), two).first()
    assert (tie["nearest"], tie["lang"], tie["rejected"]) == ("aa", None, True)


# quality classifier


def test_classifier_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = QUERIES["op8_quality_classifier"](spark, d)
    assert got.count() == docs.count()
    rows = got.where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").collect()
    pos, neg = [r[0] for r in rows if r[2] == 1], [r[0] for r in rows if r[2] == 0]
    assert np.mean([a > b for a in pos for b in neg]) > 0.95
    assert np.mean([r[1] == r[2] for r in rows]) > 0.93


def test_classifier_edge_cases(spark):
    docs = frame(spark, ["a good text here", "BAD!! BAD!!", None, "", "word " * 50_000] * 3, score=1)
    none = quality_classifier.fit(docs, docs.limit(0).select("doc_id", F.lit(1).alias("quality")))
    assert {r["score"] for r in quality_classifier.score(docs, none).collect()} == {0.5}
    one = docs.select("doc_id", F.when(F.col("text").startswith("BAD"), 0).otherwise(1).alias("quality"))
    model = quality_classifier.fit(docs, one.unionByName(one))
    got = quality_classifier.score(docs, model).orderBy("doc_id").collect()
    assert all(0 <= r["score"] <= 1 for r in got) and got[0]["score"] > got[1]["score"] and got[2]["score"] == got[3]["score"]
    assert quality_classifier.score(docs.limit(0), model).count() == 0


def test_classifier_ratios_and_scores_match_plain_python():
    """Log-count ratios, scaled indicators and the decision by sets and dictionaries; the dual's optimum by its conditions."""
    import math

    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 40, 12)) if i % 2 else np.unique(rng.integers(25, 60, 12)) for i in range(60)]
    y = np.array([1 if i % 2 else -1 for i in range(60)])
    model = quality_classifier.train(rows, y, epochs=200, blend=1.0)
    fit = [i for i in range(60) if i % 5 != 4]
    dim = 1 << quality_classifier.BITS
    n = {s: {} for s in (1, -1)}
    for i in fit:
        for f in rows[i].tolist():
            n[y[i]][f] = n[y[i]].get(f, 0) + 1
    total = {s: sum(x.values()) + dim for s, x in n.items()}
    ratio = {f: math.log(((n[1].get(f, 0) + 1) / total[1]) / ((n[-1].get(f, 0) + 1) / total[-1])) for f in range(60)}
    assert all(abs(model.scale[f] - r) < 1e-9 for f, r in ratio.items())
    decided = []
    for r in rows:
        norm = math.sqrt(sum(ratio[f] ** 2 for f in r.tolist()) + 1e-12)
        decided.append(sum(model.weights[f] * ratio[f] for f in r.tolist()) / norm + model.bias)
    flat, owner = np.concatenate(rows), np.repeat(np.arange(60), [len(r) for r in rows])
    assert np.allclose(model.decide(flat, owner, 60), decided)
    assert np.allclose(model.score(flat, owner, 60), [1 / (1 + math.exp(-(model.slope * d + model.offset))) for d in decided])
    # no small step lowers the hinge loss
    x = np.zeros((60, 61))
    for i, r in enumerate(rows):
        x[i, r] = [ratio[f] / math.sqrt(sum(ratio[g] ** 2 for g in r.tolist()) + 1e-12) for f in r.tolist()]
    x[:, 60] = 1
    cost = {s: len(fit) / (2 * sum(y[i] == s for i in fit)) for s in (1, -1)}
    w = np.append(model.weights[:60], model.bias)
    loss = lambda v: v @ v / 2 + sum(cost[y[i]] * max(0, 1 - y[i] * (x[i] @ v)) for i in fit)
    assert all(loss(w) <= loss(w + 0.05 * rng.normal(size=61)) for _ in range(300))


def test_classifier_takes_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "good text", 5, "x"), (2, "BAD!!", 6, "y")], "doc_id bigint, text string, label int, id string")
    labels = spark.createDataFrame([(1, 1, "t"), (2, 0, "t")], "doc_id bigint, quality int, text string")
    assert quality_classifier.score(docs, quality_classifier.fit(docs, labels)).count() == 2


def test_dual_descent_separates_and_keeps_its_bounds():
    rng = np.random.default_rng(0)
    x = [np.array([0, 2]) if i % 2 else np.array([1, 2]) for i in range(40)]
    y = np.array([1.0 if i % 2 else -1.0 for i in range(40)])
    w, b = quality_classifier.dual_descent(x, [np.ones(2)] * 40, y, 3, cost=np.full(40, 1.0), epochs=50)
    assert all(y[i] * (w[x[i]].sum() + b) >= 0.99 for i in range(40)) and rng is not None


# fingerprints


def test_fingerprints_of_edits_match_brute_force(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdefé 日") for _ in range(rng.choice([0, 1, 5, 9, 40, 400]))) for _ in range(60)] + [None, "", "q" * 150_000]
    ids = rng.sample(range(1000), len(texts))
    got = {r["doc_id"]: r for r in fp.fingerprint_edits(frame(spark, texts, ids, part=1, tail=2).repartition(5)).collect()}
    order = sorted(zip(ids, [t or "" for t in texts], strict=True))
    for i, (d, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        q = len(t) // 4
        edited = t[: len(t) - q] + nxt[:q]
        r = got[d]
        a, e, n = (fp.fingerprint(fp.codes_of(x)) for x in (t, edited, nxt))
        assert (r["n_chars"], r["edited"], r["fingerprint"], r["edited_fingerprint"]) == (len(t), edited, fp.to_hex(a), fp.to_hex(e))
        assert r["near_edited"] == fp.likeness(a, e) and r["near_next"] == fp.likeness(a, n)
    assert fp.fingerprint_edits(frame(spark, texts).limit(0)).count() == 0
    one = fp.fingerprint_edits(frame(spark, ["alone here in this table"])).collect()
    assert one[0]["near_next"] == 1.0
    ties = fp.fingerprint_edits(frame(spark, ["b", "a", "n", None], [1, 1, None, None]))
    assert ties.count() == 4


def plain_fingerprint(text, k=10, length=2, sketches=64):
    """Order MinHash by its definition, on whole numbers of Python."""
    m64, gold = 2**64 - 1, 0x9E3779B97F4A7C15

    def mixed(x, salt):
        x = (x + salt * gold) & m64
        x = ((x ^ x >> 33) * 0xFF51AFD7ED558CCD) & m64
        x = ((x ^ x >> 33) * 0xC4CEB9FE1A85EC53) & m64
        return x ^ x >> 33

    if not text:
        return "0" * 4 * sketches
    k, seen, numbered = min(k, len(text)), {}, []
    for i in range(len(text) - k + 1):
        h = 0
        for c in text[i : i + k]:
            h = (h * gold + mixed(ord(c), 11)) & m64
        h = mixed(h, k)
        n = seen[h] = seen.get(h, -1) + 1
        numbered.append((mixed((h + n * 0xD1342543DE82EF95) & m64, 23) if n else h) >> 32)
    out = ""
    for odd in np.random.default_rng(sketches).integers(0, 2**31, sketches, dtype=np.uint32).tolist():
        order = sorted(range(len(numbered)), key=lambda i: (numbered[i] * (2 * odd + 1) & 0xFFFFFFFF, i))
        total = 0
        for j, i in enumerate(sorted(order[:length])):
            total = mixed((total * gold + numbered[i]) & m64, j + 1)
        out += f"{total >> 48:04x}"
    return out


def test_fingerprint_core_matches_its_definition():
    rng = random.Random(9)
    texts = ["", "a", "é日", "abcdefghij", "a" * 300, "ab" * 90, "".join(rng.choice("ab") for _ in range(500)), "".join(rng.choice("abcdef 😀é") for _ in range(700))]
    for t in texts:
        assert fp.to_hex(fp.fingerprint(fp.codes_of(t))) == plain_fingerprint(t), t[:20]


def test_fingerprints_notice_order():
    rng = random.Random(4)
    words = [f"word{rng.randrange(10**6)}" for _ in range(300)]
    a = " ".join(words)
    moved = " ".join(words[150:] + words[:150])
    changed = " ".join(words[:295] + ["new"] * 5)
    f = [fp.fingerprint(fp.codes_of(x)) for x in (a, moved, changed, a)]
    assert fp.likeness(f[0], f[3]) == 1 and fp.likeness(f[0], f[2]) > fp.likeness(f[0], f[1])


# sharding


def test_table_is_even_and_moves_little():
    names = [f"s{i}" for i in range(10)]
    a, b = sharding.fill_table(names, 997), sharding.fill_table(names[:-1], 997)
    n = np.bincount(a)
    assert n.max() - n.min() <= 1
    assert sum(x != y for x, y in zip(a, b, strict=True) if x != 9) < 0.2 * 997
    with pytest.raises(ValueError):
        sharding.fill_table(names, 1000)


def test_sharding_edge_cases(spark):
    df = frame(spark, ["a", None, ""], [1, None, 1], slot="x", shard="y")
    got = sharding.assign_shards(df, ["p", "q"], size=101).orderBy("doc_id").collect()
    assert len(got) == 3 and got[1]["shard"] == got[2]["shard"]
    assert got[1]["slot"] == int(hashlib.md5(b"1").hexdigest()[:15], 16) % 101
    assert sharding.assign_shards(df.limit(0), ["p"], size=101).count() == 0


# mixing


def test_rates_match_a_local_solver(spark):
    rng = np.random.default_rng(5)
    p = rng.dirichlet([1, 1, 0.3], 200).round(3)
    tok = rng.integers(0, 900, 200)
    rows = spark.createDataFrame([(int(t), [float(v) for v in x]) for t, x in zip(tok, p, strict=True)], "n_tokens bigint, posterior array<double>")
    steps, eta, pull = mixing.fit_rates(rows, [0.5, 0.3, 0.2])
    got = rows.withColumn("r", mixing._state(F.col("posterior"), steps, eta, pull)["r"]).collect()
    r = np.array([x["r"] for x in got])
    total = np.array([x["n_tokens"] for x in got])
    post = np.array([x["posterior"] for x in got])
    assert (r >= 0).all()
    share = (post * (r * total)[:, None]).sum(0) / total.sum()
    assert np.abs(share - [0.5, 0.3, 0.2]).max() < 0.01
    # the same steps in numpy
    y = r2 = np.ones(200)
    for *g, m in steps:
        new = np.maximum(0, y - eta * (post @ np.array(g) + pull * (y - 1)))
        y, r2 = new + m * (new - r2), new
    assert np.allclose(r, r2, atol=1e-6)


def test_rates_are_the_minimum_and_totals_are_told(spark):
    rng = np.random.default_rng(11)
    p = np.repeat([[0.998, 0.001, 0.001], [0.02, 0.97, 0.01], [0.0, 0.01, 0.99], [0.6, 0.4, 0.0]], [180, 60, 50, 10], axis=0)
    tok = rng.integers(1, 900, 300)
    rows = spark.createDataFrame([(int(t), [float(v) for v in x]) for t, x in zip(tok, p, strict=True)], "n_tokens bigint, posterior array<double>")
    got = mixing.fit(rows, [0.7, 0.2, 0.1])
    r = np.array([x["r"] for x in rows.withColumn("r", mixing._state(F.col("posterior"), *got[:3])["r"]).collect()])
    target, curve, best = np.array([0.7, 0.2, 0.1]) * tok.sum(), (tok[:, None] * p * p).sum(0), np.ones(300)
    for _ in range(20_000):  # plain projected gradient
        best = np.maximum(0, best - (p @ (((best * tok) @ p - target) / curve) + 1e-3 * (best - 1)) / 3.001)
    assert got.at_minimum and np.abs(r - best).max() < 0.005
    assert np.allclose(got.reached, (r * tok) @ p, rtol=1e-6) and np.allclose(got.wanted, target)
    short = mixing.fit(rows, [0.7, 0.2, 0.1], steps=2)
    assert not short.at_minimum and len(short.steps) == 2


def test_posteriors_hold_at_every_length_of_text(spark):
    rng = np.random.default_rng(7)
    vocabulary = [f"w{i}" for i in range(120_000)]
    insults = [f"insult{i}" for i in range(12)]
    texts, domains = [], []
    for n, clean, toxic in ((60, 240, 60), (900, 60, 15), (4000, 40, 10)):
        for i in range(clean + toxic):
            words = [vocabulary[j] for j in rng.integers(0, len(vocabulary), n)]
            domains.append("toxic" if i >= clean else "clean")
            texts.append(" ".join(words + list(rng.choice(insults, 6, replace=False)) if i >= clean else words))
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, d) for i, d in enumerate(domains) if i % 5 < 3], "id bigint, domain string")  # two of five are held out
    weights, base = mixing.domain_weights(docs, labels, ["clean", "toxic"])
    got = {r["doc_id"]: r for r in mixing.posteriors(docs, weights, base).collect()}
    wrong = {}
    for i, d in enumerate(domains):
        if (got[i]["posterior"][1] > 0.5) != (d == "toxic"):
            wrong[d, got[i]["n_tokens"] // 500] = wrong.get((d, got[i]["n_tokens"] // 500), 0) + 1
    assert not wrong
    assert len(weights) < 2 * len(insults)  # of 120,000 rare words hardly one is marked by accident


def test_posteriors_match_plain_python(spark):
    """Bernoulli naive Bayes over marked words by sets of words, shapes of a text included."""
    import math

    texts = ["calm words about trains", "rude awful rude!", "AWFUL trains", "", None, "calm " * 3000 + "rude", "other words only", "calm words about trains"]
    vocabulary = {"rude": (0.05, 0.9), "awful": (0.1, 0.7), "calm": (0.8, 0.2)}
    weights, base = {}, [math.log(0.6), math.log(0.4)]
    for word, p in vocabulary.items():
        h = spark.sql(f"SELECT xxhash64('{word}')").first()[0]
        weights[h] = [math.log(x / (1 - x)) for x in p]
        base = [b + math.log(1 - x) for b, x in zip(base, p, strict=True)]
    got = {r["doc_id"]: r for r in mixing.posteriors(frame(spark, texts, figures=1, posterior="old"), weights, base).collect()}
    for i, t in enumerate(texts):
        words = re.findall(r"[a-z0-9]+", (t or "").lower())
        joint = [math.log(q) + sum(math.log(p[k] if w in words else 1 - p[k]) for w, p in vocabulary.items()) for k, q in enumerate((0.6, 0.4))]
        want = [math.exp(j) / sum(map(math.exp, joint)) for j in joint]
        assert got[i]["n_tokens"] == len(words) and np.allclose(got[i]["posterior"], want, atol=6e-4)


def test_mixing_edge_cases(spark):
    df = frame(spark, ["good words here", None, "", "bad " * 30_000, "good words here"], [1, None, 2, 3, 1], rate="x", posterior="y")
    labels = spark.createDataFrame([(1, "clean"), (3, "toxic"), (None, "toxic")], "id bigint, domain string")
    got = mixing.mix_sources(df, labels, {"clean": 0.6, "toxic": 0.4}, steps=3).collect()
    assert len(got) == 5 and all(r["copies"] >= 0 and r["rate"] >= 0 for r in got)
    assert mixing.mix_sources(df, labels.limit(0), {"clean": 0.6, "toxic": 0.4}, steps=2).count() == 5
    assert mixing.mix_sources(df.limit(0), labels, {"clean": 1.0}).count() == 0


def test_all_queries_return_a_row_for_each_document(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name, q in QUERIES.items():
        if not name.startswith("op6"):
            assert q(spark, SF).count() == n, name
    assert zlib.crc32(b"") == 0
