"""Quality classifier: a linear support vector machine on n-gram indicators scaled by naive Bayes log-count ratios.

Features are hashed word uni- and bigrams and n-grams of word shapes (letter case and punctuation at a word's ends, and whether it repeats
the word before). Labels and texts of a bounded sample come to the driver, where dual coordinate descent fits the hinge loss;
scoring is one pass over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tokens import slices

BITS = 18
_CLASS = np.zeros(256, np.uint64)  # 0 other bytes
_CLASS[97:123], _CLASS[128:] = 1, 1
_CLASS[65:91], _CLASS[48:58] = 2, 3
_CLASS[[*b".,;:'\"()"]] = 4
_CLASS[[*b"!?"]] = 5


def features(texts) -> tuple[np.ndarray, np.ndarray]:
    """(feature ids, text of each) of an Arrow array of strings: each feature once for a text, texts in order."""
    from strata.llm.wordhash import mix, spans, words

    h, at = words(texts)
    n = len(h)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    data, start, end = spans(texts)
    last2 = np.maximum(end - 2, start)
    same = np.zeros(n, np.uint64)
    same[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    shape = ((_CLASS[data[start]] * np.uint64(8) + _CLASS[data[last2]]) * np.uint64(8) + _CLASS[data[end - 1]]) * np.uint64(2) + same
    s1 = mix(shape, 3)
    u = np.uint64
    grams, owners = [h, s1], [text, text]
    for k in (1, 2):
        ok = text[k:] == text[:-k]
        grams.append((mix(s1[:-k] * u(3) + s1[k:] * u(5) + (s1[1:-1] * u(7) if k == 2 else u(0)), 4 + k))[ok])
        owners.append(text[k:][ok])
        if k == 1:
            grams.append(mix(h[:-1] * u(3) + h[1:] * u(5), 9)[ok])
            owners.append(text[1:][ok])
    ids = np.concatenate(grams) >> u(64 - BITS)
    key = np.unique(np.concatenate(owners).astype(np.int64) << BITS | ids.astype(np.int64))
    return key & ((1 << BITS) - 1), key >> BITS


@dataclass
class Model:
    weights: np.ndarray  # of the scaled indicators
    scale: np.ndarray  # log-count ratios
    bias: float
    slope: float
    offset: float

    def decide(self, ids: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        total = np.bincount(text, self.weights[ids] * self.scale[ids], n)
        norm = np.sqrt(np.bincount(text, self.scale[ids] ** 2, n) + 1e-12)
        return total / norm + self.bias

    def score(self, ids: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.decide(ids, text, n) + self.offset, -30, 30)))


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, dim: int, *, cost: np.ndarray, epochs: int, seed: int = 1) -> tuple[np.ndarray, float]:
    """(w, b) of the L1-loss support vector machine: coordinates of the dual are set to their best value in turn."""
    rng = np.random.default_rng(seed)
    w, b, alpha = np.zeros(dim), 0.0, np.zeros(len(y))
    q = np.array([v @ v for v in values]) + 1.0
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            g = y[i] * (w[rows[i]] @ values[i] + b) - 1
            new = min(max(alpha[i] - g / q[i], 0.0), cost[i])
            if (d := (new - alpha[i]) * y[i]) != 0.0:
                w[rows[i]] += d * values[i]
                b += d
                moved = max(moved, abs(d))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w, b


def train(rows: list[np.ndarray], y: np.ndarray, *, cost: float = 1.0, epochs: int = 30, smooth: float = 1.0, blend: float = 0.25) -> Model:
    """Fit on distinct feature ids of each row and labels of -1 and 1; every fifth row calibrates the score."""
    dim = 1 << BITS
    held = np.arange(len(y)) % 5 == 4
    fit = np.flatnonzero(~held)
    count = {s: np.bincount(np.concatenate([rows[i] for i in fit if y[i] == s] or [np.zeros(0, np.int64)]), minlength=dim) + smooth for s in (-1, 1)}
    ratio = np.log((count[1] / count[1].sum()) / (count[-1] / count[-1].sum()))
    values = [ratio[r] / np.sqrt((ratio[r] ** 2).sum() + 1e-12) for r in rows]
    n = {s: max(1, int((y[fit] == s).sum())) for s in (-1, 1)}
    weight = np.array([cost * len(fit) / (2 * n[int(s)]) for s in y[fit]])
    w, b = dual_descent([rows[i] for i in fit], [values[i] for i in fit], y[fit], dim, cost=weight, epochs=epochs)
    used = np.concatenate([rows[i] for i in fit] or [np.zeros(0, np.int64)])
    mean = np.abs(w[np.unique(used)]).mean() if len(used) else 0.0
    w = blend * w + (1 - blend) * mean  # towards naive Bayes, whose weight is the same for all
    f = np.array([w[r] @ v + b for r, v in zip(rows, values, strict=True)])
    slope, offset = _logistic(f[held], y[held]) if len({*y[held]}) == 2 else (1.0, 0.0)
    return Model(w, ratio, b, slope, offset)


def _logistic(f: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of P(1 | f), by Newton steps with a small ridge and softened labels."""
    pos, neg = (y > 0).sum(), (y < 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([f, np.ones_like(f)], 1)
    a = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        a += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2), x.T @ (t - p) - 1e-4 * a)
    return float(a[0]), float(a[1])


def _feature_rows(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for b in slices(batches, "text"):
        ids, text = features(b["text"])
        ends = np.searchsorted(text, np.arange(b.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([b["label"], pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))], names=["label", "ids"])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = 6000, **kw) -> Model:
    """A model from a sample of at most ``most`` labelled rows, picked by a hash of their id.

    The sample of labels is what is broadcast (16 bytes a row), and its feature ids are what the driver gathers. Rows with a null id or
    label teach nothing; labels of an id that repeats are taken once, the largest. With one class, or none, every score is 0.5.
    """
    labels = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    share = min(1.0, 1.1 * most / max(1, labels.count()))
    h = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    picked = labels.where(h < share * (1 << 30)).orderBy(h, "id").limit(most)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(picked), "id").select("id", "label", "text")
    got = rows.select("label", "text").mapInArrow(_feature_rows, "label int, ids array<int>").toArrow()
    y = np.where(got["label"].to_numpy() > 0, 1, -1)
    found = [np.asarray(x, np.int64) for x in got["ids"].to_numpy()]
    order = sorted(range(len(y)), key=lambda i: (len(found[i]), found[i].tobytes(), y[i]))  # the same fit whatever order the rows come in
    order = np.random.default_rng(0).permutation(order) if order else []
    y, found = y[order] if len(y) else y, [found[i] for i in order]
    if len({*y.tolist()}) < 2:
        z = np.zeros(1 << BITS)
        return Model(z, z, 0.0, 0.0, 0.0)
    return train(found, y, **kw)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for each row of ``docs``: the probability of label 1, from the whole text alone.

    Defined results: a null or empty text has no features and scores what the bias gives; very long texts, ties, repeated rows and null ids
    change nothing, since each row is judged alone; an empty table gives an empty table; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 x 2**18 doubles: 4 MB

    def run(batches):
        import pyarrow as pa

        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(shared.value.score(*features(b["text"]), b.num_rows))], names=["id", "score"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)
