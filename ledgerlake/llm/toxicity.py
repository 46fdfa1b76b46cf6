"""Toxicity by a classifier chain.

The categories are predicted one after the other by linear models over the words and word beginnings of a text; each
model also sees the probabilities of the categories before it. While learning, those are out-of-fold predictions.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from ledgerlake.llm.common import by_slice, stash

#: The chain: a name and the label column and value that mark it.
CHAIN = (("low_quality", "quality", 0), ("toxic", "toxic", 1))
#: Labelled rows that are learned from at most, features chosen for each category, least documents with a feature, and
#: least standard score of the difference between the shares of marked and other documents with it.
TRAIN_ROWS, FEATURES, LEAST = 16_000, 300, 4
LEAST_SCORE = 5.0
STARTS = (4, 5)
#: Bytes beyond which a word is known by its digest, and not remembered.
LONG_WORD = 64
FOLDS, STEPS, RIDGE = 5, 300, 0.05
#: Words whose features a worker remembers; when full it starts anew.
CACHE = 200_000
#: Blanks the ASCII bytes that are no letters, and keeps all others.
LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def word_features(word: bytes) -> list[bytes]:
    """The word, by its digest where it is long, and its beginnings."""
    whole = b"=" + word if len(word) <= LONG_WORD else b"#" + xxhash.xxh3_128_digest(word)
    return [whole, *[b"^" + word[:n] for n in STARTS if len(word) >= n]]


@dataclass
class Linear:
    weight: np.ndarray
    bias: float

    def predict(self, row: np.ndarray, col: np.ndarray, n: int, more: np.ndarray) -> np.ndarray:
        """Probabilities for n rows, given the (row, column) places of ones and the earlier probabilities."""
        k = more.shape[1]
        z = self.bias + np.bincount(row, self.weight[col + k], n) + more @ self.weight[:k]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(row: np.ndarray, col: np.ndarray, width: int, more: np.ndarray, y: np.ndarray) -> Linear:
    """Ridge logistic regression by accelerated gradient steps; columns of ``more`` come first."""
    n, k = more.shape
    w, v, b, vb, t = np.zeros(k + width), np.zeros(k + width), 0.0, 0.0, 1.0
    u, size = np.ones(k + width + 1), 1.0
    for _ in range(20 if n else 0):  # the largest curvature, by power iteration
        z = u[-1] + np.bincount(row, u[col + k], n) + more @ u[:k]
        u = np.r_[more.T @ z, np.bincount(col, z[row], width), z.sum()]
        size = max(np.linalg.norm(u), 1e-9)
        u = u / size
    rate = 1 / (0.27 * size + RIDGE)
    for _ in range(STEPS if n else 0):
        z = vb + np.bincount(row, v[col + k], n) + more @ v[:k]
        r = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.r_[more.T @ r, np.bincount(col, r[row], width)] + RIDGE * v
        nw, nb = v - rate * g, vb - rate * r.sum()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if g @ (nw - w) > 0:  # it overshot: begin anew from here
            t2 = 1.0
        v, vb = nw + (t - 1) / t2 * (nw - w), nb + (t - 1) / t2 * (nb - b)
        w, b, t = nw, nb, t2
    return Linear(w, float(b))


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    columns = [F.max((F.col(c) == v).cast("int")).alias(name) for name, c, v in CHAIN]
    usable = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(*columns).dropna()
    picked = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    return stash(docs.select("doc_id", F.lower("text").cast("binary").alias("low")).join(F.broadcast(picked), "doc_id"), "sample")


def choose(sample: DataFrame) -> list[bytes]:
    """The features that go with a category most clearly, from document counts over the sample."""
    names = [c[0] for c in CHAIN]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = [Counter() for _ in range(len(names) + 1)]
        marks = [batch.column(n).to_pylist() for n in names]
        for i, t in enumerate(batch.column("low").to_pylist()):
            got = {f for w in set((t or b"").translate(LETTERS).split()) for f in word_features(w)}
            counts[-1].update(got)
            for c, m in zip(counts, marks, strict=False):
                if m[i]:
                    c.update(got)
        keys = list(counts[-1])
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *[pa.array([c[k] for k in keys], pa.int64()) for c in counts]], ["feature", *names, "n"])

    schema = "feature binary, " + ", ".join(f"{n} bigint" for n in (*names, "n"))
    counts = stash(sample.mapInArrow(by_slice(work), schema).groupBy("feature").agg(*[F.sum(n).alias(n) for n in (*names, "n")]).filter(F.col("n") >= LEAST), "counts")
    total = sample.agg(F.count("*").alias("n"), *[F.sum(n).alias(n) for n in names]).first()
    chosen: dict[bytes, None] = {}
    for name in names:
        all_, of = total.n, total[name] or 0
        if not 0 < of < all_:
            continue
        share, other = F.col(name) / of, (F.col("n") - F.col(name)) / (all_ - of)
        both = F.col("n") / all_
        z = F.abs(share - other) / F.sqrt(both * (1 - both) * (1 / of + 1 / (all_ - of)) + 1e-12)
        chosen |= {bytes(r.feature): None for r in counts.filter(z >= LEAST_SCORE).orderBy(F.desc(z), "feature").limit(FEATURES).select("feature").collect()}
    return list(chosen)


class Places(dict):
    """Columns of each word's chosen features."""

    def __init__(self, features: list[bytes]):
        super().__init__()
        self.column = {f: k for k, f in enumerate(features)}

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        got = tuple(self.column[f] for f in word_features(word) if f in self.column)
        if len(word) <= LONG_WORD:
            if len(self) >= CACHE:
                self.clear()
            self[word] = got
        return got

    def of(self, text: bytes) -> set[int]:
        return {c for w in set(text.translate(LETTERS).split()) for c in self[w]}


def _flat(places: list) -> tuple[np.ndarray, np.ndarray]:
    row = np.repeat(np.arange(len(places)), [len(p) for p in places]).astype(np.int64)
    return row, np.fromiter((c for p in places for c in p), np.int64, len(row))


@dataclass
class Chain:
    features: list[bytes]
    links: list[Linear]
    #: Probability of the last category from which it is said to hold.
    cut: float = 0.5

    def predict(self, places: list) -> np.ndarray:
        """Probability of every category, in the chain's order, for each row of feature places."""
        (row, col), n = _flat(places), len(places)
        more = np.zeros((n, 0))
        for link in self.links:
            more = np.c_[more, link.predict(row, col, n, more)]
        return more


def train(docs: DataFrame, labels: DataFrame) -> Chain:
    """Chain learned from a bounded sample: the TRAIN_ROWS labelled doc_ids with the lowest hash."""
    sample = _sample(docs, labels)
    features, names = choose(sample), [c[0] for c in CHAIN]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = Places(features)
        got = pa.array([sorted(at.of(t or b"")) for t in batch.column("low").to_pylist()], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *[batch.column(n) for n in names], got], ["doc_id", *names, "places"])

    schema = sample.select("doc_id", *names).schema.add("places", ArrayType(IntegerType()))
    rows = sorted(tuple(r) for r in sample.mapInArrow(by_slice(work), schema).collect())
    n = len(rows)
    fold = np.array([zlib.crc32(str(r[0]).encode()) % FOLDS for r in rows], np.int64)
    row, col = _flat([r[-1] for r in rows])
    more, links = np.zeros((n, 0)), []
    for k in range(len(names)):
        y = np.array([r[k + 1] for r in rows], float)
        links.append(fit_linear(row, col, len(features), more, y))
        held = np.zeros(n)
        for f in range(FOLDS):
            old = fold != f
            new_row, keep = np.cumsum(old) - 1, old[row]
            part = fit_linear(new_row[row[keep]], col[keep], len(features), more[old], y[old])
            held[~old] = part.predict(row, col, n, more)[~old]
        more = np.c_[more, held]
    return Chain(features, links, best_cut(held, y) if n else 0.5)


def best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """The probability from 0.03 to 0.9 from which calling rows positive gives the best F1; the middle one among equals."""
    cuts = np.r_[np.arange(0.03, 0.1, 0.01), np.arange(0.1, 0.91, 0.02)]
    f1 = np.array([2 * y[p >= c].sum() / max(1, (p >= c).sum() + y.sum()) for c in cuts])
    best = cuts[f1 >= f1.max() - 1e-9]
    return float(best[len(best) // 2])


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, p_<category> for each category of the chain, and toxic (p_toxic at least the chain's cut) for every whole text.

    docs: doc_id, text; further columns are ignored. Null and empty texts have no features and get the base rates;
    repeated rows are each scored; an empty table gives an empty result. No shuffle.
    """
    names = [f"p_{c[0]}" for c in CHAIN]
    schema = docs.select("doc_id").schema
    for c in names:
        schema = schema.add(c, "double")

    def work(batches):
        at = Places(chain.features)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            p = chain.predict([at.of(t or b"") for t in batch.column(1).to_pylist()])
            return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in p.T]], ["doc_id", *names])

        yield from by_slice(one)(batches)

    got = docs.select("doc_id", F.lower("text").cast("binary").alias("low")).mapInArrow(work, schema)
    return got.withColumn("toxic", F.col("p_toxic") >= chain.cut)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
