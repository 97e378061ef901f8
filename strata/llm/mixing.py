"""Soft-membership mixing: documents are repeated or thinned so that expected domain token totals match targets.

A naive Bayes classifier, learnt from a labelled table, gives each document a posterior over domains. Nonnegative rates r solve

    min  1/2 sum_k (sum_i r_i tokens_i p_ik - T_k)^2 / S_k  +  lambda / 2 sum_i tokens_i (r_i - 1)^2 / total,   r >= 0

(S_k = sum_i tokens_i p_ik^2) by projected gradient with momentum: each step is one distributed sum per domain. A rate depends on the posterior alone, so
steps run over (posterior, tokens) sums, and the finished steps are replayed as one expression on each document. DataFrame functions only.
"""

from __future__ import annotations

import itertools
import logging
import math
from collections import Counter
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.shared import free_name, let, stage, without

_log = logging.getLogger(__name__)

def _share(count: Column, n: Column) -> Column:
    return F.floor(F.least(10 * count / F.greatest(n, F.lit(1)), F.lit(6))).cast("string")


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _features(text: Column, words: Column) -> Column:
    """64-bit hashes of the distinct features: words, and coarse shares of symbols, marks, capitals and distinct words."""
    n = F.size(words)

    def all_of(distinct):
        shape = F.array(
            F.concat(F.lit("#symbols "), _share(F.regexp_count(text, F.lit("[#*$%&|<>]")), n)), F.concat(F.lit("#marks "), _share(F.regexp_count(text, F.lit("[!?]")), n)),
            F.concat(F.lit("#capitals "), _share(F.regexp_count(text, F.lit("[A-Z]")), F.length(text))), F.concat(F.lit("#distinct "), _share(F.size(distinct), n)))
        return F.array_union(distinct, _hashed(shape))

    return let(F.array_distinct(_hashed(words)), all_of)


def _words(text: Column) -> Column:
    """Runs of a-z, digits and characters beyond ASCII, in lower case."""
    return F.array_remove(F.split(F.lower(text), r"[\x00-/:-`{-\x7f]+"), "")


def domain_weights(docs: DataFrame, labelled: DataFrame, domains: list[str], *, id_col: str = "doc_id", text_col: str = "text", sample: int = 8000, **kw):
    """weights_of a sample of the labelled texts (labelled_texts)."""
    return weights_of(labelled_texts(docs, labelled, domains, id_col=id_col, text_col=text_col, sample=sample), domains, **kw)


def labelled_texts(docs: DataFrame, labelled: DataFrame, domains: list[str], *, id_col: str = "doc_id", text_col: str = "text", sample: int = 8000) -> DataFrame:
    """(text, domain, held) to learn from, staged; about a quarter is held out for calibration.

    A sample of at most ``sample`` labelled rows (id, domain), picked by a hash of the id, which is what is broadcast (32 bytes a row). Rows with a null
    id or another domain teach nothing, an id with two domains has the first by name, null texts are empty; without labels no feature is marked
    and all domains are equal.
    """
    labelled = labelled.where(F.col("id").isNotNull() & F.col("domain").isin(domains)).groupBy("id").agg(F.min("domain").alias("domain"))
    h = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    picked = labelled.where(h < min(1.0, 1.1 * sample / max(1, labelled.count())) * (1 << 30)).orderBy(h, "id").limit(sample)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).join(F.broadcast(picked), "id")
    parts = min(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return stage(rows.repartition(parts, "id").select("text", "domain", (F.pmod(F.xxhash64("id"), F.lit(1 << 32)) % 4 == 3).alias("held")), "labelled-texts")


def weights_of(rows: DataFrame, domains: list[str], *, least_z: float = 3.0, least_lift: float = 2.5, chance: float = 10.0):
    """(hash of a marked feature: its log odds in each domain, for each domain the score of a text with none) of rows (text, domain): Bernoulli naive Bayes.

    Only features are marked that some domain's texts have ``least_lift`` times as often as all texts, and ``least_z`` deviations more than its share
    would give: what a short text hasn't then says little. And of all features, however many there are, about ``chance`` are expected to be marked by
    accident (Chernoff's bound on the count): held out, fewer than one lose rare words of a domain, and more add noise. Features are told
    apart by 64-bit hashes (two of n are taken for one with a chance of n**2 / 2**65).
    """
    rows = rows.select("domain", _features(F.col("text"), _words(F.col("text"))).alias("f"))
    # every text has the feature null, which counts the texts of a domain
    counts = stage(rows.select("domain", F.explode(F.concat("f", F.array(F.lit(None).cast("bigint")))).alias("feature")).groupBy("domain", "feature").agg(F.count("*").alias("n")), "domain-counts")
    texts = {r["domain"]: r["n"] for r in counts.where("feature IS NULL").collect()}
    n_texts = sum(texts.values())
    odds, base = {}, [math.log((texts.get(d, 0) + 1) / (n_texts + len(domains))) for d in domains]
    if n_texts:
        own = [F.coalesce(F.sum(F.when(F.col("domain") == d, F.col("n"))), F.lit(0)) for d in domains]
        expected = [F.sum("n") * (texts.get(d, 0) / n_texts) for d in domains]
        marked = [(n - e >= least_z * F.sqrt(e + 1)) & (n >= least_lift * e) for n, e in zip(own, expected, strict=True)]
        counts = counts.where("feature IS NOT NULL")
        tried = len(domains) * max(1, counts.select("feature").distinct().count())
        marked = [m & (F.when(n > 0, n * F.log(n / e) - n + e) >= math.log(tried / chance)) for m, n, e in zip(marked, own, expected, strict=True)]
        table = counts.groupBy("feature").agg(F.array(*[F.coalesce(m, F.lit(False)) for m in marked]).alias("marked"), F.array(*own).alias("n")).where(F.array_contains("marked", True))
        for r in table.orderBy("feature").collect():  # each takes some ten texts of the sample
            row = odds[r["feature"]] = []
            for k, d in enumerate(domains):
                p = (r["n"][k] + 1) / (texts.get(d, 0) + 2)
                row.append(math.log(p / (1 - p)))
                base[k] += math.log(1 - p)
    return odds, base


def calibration(rows: DataFrame, domains: list[str], *, prior: float = 20.0, **kw) -> list[list[float]]:
    """For each domain, how the tokens given to it by the posteriors are truly spread over domains: row times matrix makes totals come out.

    Learnt from weights of the rows that aren't held out, and the held ones' tokens. Each row of the matrix has the tokens of ``prior`` mean texts on
    its diagonal besides, so few labels change little; without held rows it is the identity.
    """
    weights, base = weights_of(rows.where("NOT held"), domains, **kw)
    held = posteriors(rows.where("held"), weights, base)
    own = [F.sum(F.when(F.col("domain") == d, F.col("n_tokens") * F.col("posterior")[j])) for j in range(len(domains)) for d in domains]
    got = held.agg(F.count("*"), F.sum("n_tokens"), *own).first()
    mean = (got[1] or 0) / max(1, got[0])
    k, out = len(domains), []
    for j in range(k):
        row = [(got[2 + j * k + i] or 0.0) + (prior * mean if i == j else 0.0) for i in range(k)]
        out.append([x / sum(row) for x in row] if sum(row) else [float(i == j) for i in range(k)])
    return out


def calibrated(posterior: Column, matrix: list[list[float]]) -> Column:
    """A posterior times the matrix of calibration(), to three places."""
    return F.array(*[F.round(sum((posterior[j] * F.lit(row[k]) for j, row in enumerate(matrix)), F.lit(0.0)), 3) for k in range(len(matrix))])


def posteriors(docs: DataFrame, weights: dict[int, list[float]], base: list[float], *, text_col: str = "text", temper: float = 1.0) -> DataFrame:
    """``docs`` with n_tokens (runs of letters and digits) and posterior (array, to three places), both from the whole text.

    Defined results: a null or empty text has no tokens and the posterior of a text without marked words; very long texts are read whole; ties
    between domains stay ties; repeated rows get equal figures; an empty table gives an empty table; input columns of these names are replaced.
    """
    docs = without(docs, "n_tokens", "posterior")
    text = F.coalesce(F.col(text_col), F.lit(""))
    # constants of the plan: the optimizer folds each text of numbers to one array literal
    def constant(numbers, kind):
        return F.split(F.lit(",".join(map(repr, numbers))), ",").cast(f"array<{kind}>") if numbers else F.array().cast(f"array<{kind}>")

    # a hash table of two slots or more for each marked feature: slot s has the keys from start[s] up to start[s + 1]
    size = 1 << max(4, (2 * len(weights)).bit_length())
    order = sorted(weights, key=lambda h: h % size)
    held = Counter(h % size for h in order)
    starts = list(itertools.accumulate((held[s] for s in range(size)), initial=0))
    start, marked, odds = constant(starts, "int"), constant(order, "bigint"), [constant([weights[h][k] for h in order], "double") for k in range(len(base))]

    def figures(words):
        def normal(logits):
            return let(F.transform(logits, lambda x: F.exp(F.greatest(x - F.array_max(logits), F.lit(-30.0)))), lambda e: F.transform(e, lambda x: F.round(x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b), 3)))

        def total(b, k):
            return F.aggregate(b, F.lit(0.0), lambda acc, at: acc + odds[k][at])

        def place(h):
            return let(F.pmod(h, F.lit(size)).cast("int"), lambda s: start[s] + (F.array_position(F.slice(marked, start[s] + 1, start[s + 1] - start[s]), h) - 1).cast("int"))

        def logits(b):
            return F.array(*[temper * (F.lit(score) + total(b, k)) for k, score in enumerate(base)])

        return F.struct(F.size(words).cast("long").alias("n_tokens"), let(F.transform(F.array_intersect(_features(text, words), marked), place), lambda b: let(logits(b), normal)).alias("posterior"))

    m = free_name(docs, "figures")
    return docs.withColumn(m, let(_words(text), figures)).select(*[F.col(f"`{c}`") for c in docs.columns], f"{m}.n_tokens", f"{m}.posterior")


def _state(posterior: Column, steps: list[list[float]], eta: float, pull: float, start: Column | None = None) -> Column:
    """(r, y, d, q) after all steps, d and q being how far the last one went from y and from r, a step being the gradient's domain parts and the momentum: r' <- max(0, y - eta (p . g + pull (y - 1))), y <- r' + m (r' - r)."""
    start = F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("y"), F.lit(0.0).alias("d"), F.lit(0.0).alias("q")) if start is None else start
    if not steps:
        return start
    def dot(g):
        return F.aggregate(F.zip_with(posterior, g, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)

    def step(s, x):
        r = F.greatest(F.lit(0.0), s["y"] - eta * (dot(x["g"]) + pull * (s["y"] - 1)))
        return let(r, lambda new: F.struct(new.alias("r"), (new + x["m"] * (new - s["r"])).alias("y"), (new - s["y"]).alias("d"), (new - s["r"]).alias("q")))

    # the steps as one constant, which the optimizer folds
    text = ";".join(",".join(f"{v:.12g}" for v in row) for row in steps)
    rows = F.transform(F.split(F.lit(text), ";"), lambda row: F.split(row, ",").cast("array<double>"))
    rows = F.transform(rows, lambda row: F.struct(F.slice(row, 1, len(steps[0]) - 1).alias("g"), F.element_at(row, len(steps[0])).alias("m")))
    return F.aggregate(rows, start, step)


class Fit(NamedTuple):
    """The steps taken, and the expected totals at their end next to the wanted ones; ``at_minimum`` tells whether steps ended before they ran out."""

    steps: list[list[float]]
    eta: float
    pull: float
    reached: list[float]
    wanted: list[float]
    at_minimum: bool


def fit(rows: DataFrame, shares: list[float], *, scale: float = 1.0, pull: float = 1e-3, steps: int = 300, tolerance: float = 1e-3) -> Fit:
    """Rates for rows (n_tokens, posterior): expected totals near shares x scale x all tokens.

    Projected gradient with momentum, which starts anew when a step has gone against the gradient; each step is one sum over the distinct posteriors, whose state is written every tenth step. Ends when the
    last step's projected gradient (its mean square over tokens) is so small that rates are within ``tolerance`` of the minimum's, the curvature being ``pull`` at least.
    Totals don't end it: the minimum leaves them off their targets by what pull weighs, or by more where no rates reach them. Both that and steps that ran
    out are logged.
    """
    k = len(shares)
    sums = stage(rows.groupBy("posterior").agg(F.sum("n_tokens").alias("tokens")), "posteriors")
    p = lambda i: F.col("posterior")[i]
    first = sums.agg(F.sum("tokens").alias("total"), *[F.sum(F.col("tokens") * p(i) * p(i)).alias(f"s{i}") for i in range(k)]).first()
    total = first["total"]
    if not total:
        return Fit([], 1.0, pull, [0.0] * k, [0.0] * k, True)
    target = [s / sum(shares) * scale * total for s in shares]
    curve = [max(first[f"s{i}"] or 0.0, 1e-9 * total) for i in range(k)]
    eta, taken, since, going = 1.0 / (k + pull), [], 0, 0
    sums = sums.withColumn("s", _state(F.col("posterior"), [], eta, pull)).persist()  # small next to the staged table that it comes from again if it is lost
    for t in range(steps + 1):
        if t - since == 10:
            ahead = stage(sums.withColumn("s", _state(F.col("posterior"), taken[since:], eta, pull, F.col("s"))), "rates").persist()
            sums.unpersist()
            sums, since = ahead, t
        at = sums.withColumn("s", _state(F.col("posterior"), taken[since:], eta, pull, F.col("s"))).select("posterior", "tokens", "s.r", "s.y", "s.d", "s.q")
        got = at.agg(*[F.sum(F.col("tokens") * F.col(c) * p(i)) for c in "ry" for i in range(k)], F.sum(F.col("tokens") * F.col("d") * F.col("q")), F.sum(F.col("tokens") * F.pow(F.col("d"), 2))).first()
        done = t > 0 and math.sqrt(got[-1] / total) <= eta * tolerance * (pull or 1.0)
        if done or t == steps:
            break
        going = 0 if got[-2] < 0 else going
        taken.append([(x - want) / c for x, want, c in zip(got[k : 2 * k], target, curve, strict=True)] + [going / (going + 3)])
        going += 1
    sums.unpersist()
    result = Fit(taken, eta, pull, list(got[:k]), target, done)
    off = max(abs(x - want) / max(want, 1e-9 * total) for x, want in zip(result.reached, target, strict=True))
    told = "totals %s for targets %s after %d steps, %s"
    _log.log(logging.INFO if done and off < 0.01 else logging.WARNING, told, result.reached, target, len(taken), "at the minimum" if done else "short of the minimum")
    return result


def fit_rates(rows: DataFrame, shares: list[float], **kw):
    """(steps taken, eta, pull) of ``fit``."""
    return fit(rows, shares, **kw)[:3]


def mix_sources(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], *, id_col: str = "doc_id", text_col: str = "text", scale: float = 1.0, seed: int = 42, **kw) -> DataFrame:
    """``docs`` with n_tokens, posterior, rate and copies (long): how often each row goes into the mix.

    ``labelled`` is (id, domain); ``targets`` the wanted share of tokens of each domain. copies is the rate rounded down, and one more with the chance of
    its fraction, by a hash of the id: the expected count is the rate. Input columns of these names are replaced. The metadata of the column rate hold
    the tokens wanted and reached of each domain, and whether the rates are the minimum's.

    Defined results: a null or empty text has no tokens and the posterior of its shape; a null id hashes like any value; repeated rows get the same
    rate and copies; without labels all posteriors are equal; an empty table gives an empty table; a very long text is read whole.
    """
    docs = without(docs, "n_tokens", "posterior", "rate", "copies")
    domains = list(targets)
    learnt = labelled_texts(docs, labelled, domains, id_col=id_col, text_col=text_col)
    weights, base = weights_of(learnt, domains)
    seen = posteriors(docs, weights, base, text_col=text_col)
    seen = stage(seen.withColumn("posterior", calibrated(F.col("posterior"), calibration(learnt, domains))), "posteriors")  # texts are read once
    found = fit(seen.select("n_tokens", "posterior"), list(targets.values()), scale=scale, **kw)
    told = {"wanted": dict(zip(domains, found.wanted, strict=True)), "reached": dict(zip(domains, found.reached, strict=True)), "at_minimum": found.at_minimum}
    chance = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    rated = seen.withColumn("rate", F.round(_state(F.col("posterior"), *found[:3])["r"], 6)).withMetadata("rate", told)
    return rated.withColumn("copies", F.floor("rate") + F.when(chance < F.col("rate") - F.floor("rate"), 1).otherwise(0))


#: Domains of the labels table, and the share of tokens each is to have.
TARGETS = {"clean": 0.90, "low": 0.05, "toxic": 0.05}


def label_domains(labels: DataFrame) -> DataFrame:
    """(id, domain) of the table labels: toxic, else clean or low by quality."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean").when(F.col("quality") == 0, "low")
    return labels.select(F.col("doc_id").alias("id"), domain.alias("domain"))
