"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are taken from a text's bytes. Trees grow level by level from histograms of binned statistics; the forest is
flattened into arrays that a batch of documents walks at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ledgerlake.llm.common import by_slice, is_in_fold

#: Labelled rows that are learned from at most: those with the lowest hash of doc_id.
TRAIN_ROWS = 8000
TREES, DEPTH, BINS, RATE, RIDGE, LEAST = 60, 4, 64, 0.15, 2.0, 10
HELD_OUT = (3, 1)
FEATURES = (
    "log_bytes", "log_words", "word_bytes", "longest_word", "upper", "digit", "space", "point", "symbol", "high", "bang",
    "words_a_line", "repeated_lines", "distinct_words", "odd_ends", "upper_after_lower", "entropy",
)
_KINDS = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" \t\n\r\x0b\x0c", "point": b".,;:?'\"()-", "symbol": b"#*$%&|<>@^~=+_/\\{}[]", "bang": b"!"}
_KIND = np.zeros((256, len(_KINDS) + 1))
for _k, _chars in enumerate(_KINDS.values()):
    _KIND[list(_chars), _k] = 1
_KIND[128:, -1] = 1
_ODD = np.zeros(256, bool)
_ODD[list(_KINDS["symbol"] + _KINDS["bang"])] = True


def statistics(text: bytes) -> list[float]:
    """FEATURES of one text; all zero for an empty one."""
    b = np.frombuffer(text, np.uint8)
    if not len(b):
        return [0.0] * len(FEATURES)
    count = np.bincount(b, minlength=256)
    upper, digit, space, point, symbol, bang, high = (count @ _KIND / len(b)).tolist()
    share = count[count > 0] / len(b)
    words, lines = text.split(), text.split(b"\n")
    ends = np.flatnonzero(b == 32)
    ends = b[ends[ends > 0] - 1]
    is_upper = (b >= 65) & (b <= 90)
    n = max(1, len(words))
    return [
        np.log1p(len(b)), np.log1p(len(words)), sum(map(len, words)) / n, float(max(map(len, words), default=0)), upper, digit, space, point, symbol, high, bang,
        len(words) / len(lines), 1 - len(set(lines)) / len(lines), len(set(words)) / n, float(_ODD[ends].mean()) if len(ends) else 0.0,
        float((is_upper[1:] & is_upper[:-1]).mean()) if len(b) > 1 else 0.0, float(-(share * np.log2(share)).sum()),
    ]


@dataclass(frozen=True)
class Forest:
    """Trees as heap-ordered arrays: node k has children 2k+1 (at most the threshold) and 2k+2."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            total += value[at - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Forest for labels y (0 or 1) from rows of statistics; without rows every score is one half."""
    inner = 2**DEPTH - 1
    if not len(y):
        return Forest(0.0, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(cuts, x.T, strict=True)], axis=1)
    p = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(p / (1 - p)))
    total, trees = np.full(len(y), base), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        feature, threshold, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            nodes, first = 2**level, 2**level - 1
            best = np.full(nodes, 1e-6)
            local = at - first
            split = np.full(nodes, -1)
            for f, edges in enumerate(cuts):
                cell = local * BINS + binned[:, f]
                sums = [np.cumsum(np.bincount(cell, w, nodes * BINS).reshape(nodes, BINS), axis=1) for w in (g, h, np.ones(len(y)))]
                left, all_ = [s[:, :-1] for s in sums], [s[:, -1:] for s in sums]
                part = lambda a, b: a**2 / (b + RIDGE)
                gain = part(left[0], left[1]) + part(all_[0] - left[0], all_[1] - left[1]) - part(all_[0], all_[1])
                gain[(left[2] < LEAST) | (all_[2] - left[2] < LEAST)] = -1
                gain[:, len(edges) :] = -1
                top = gain.argmax(axis=1)
                better = gain[np.arange(nodes), top] > best
                best = np.where(better, gain[np.arange(nodes), top], best)
                feature[first : first + nodes][better] = f
                split[better] = top[better]
                threshold[first : first + nodes][better] = edges[top[better]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > threshold[at])
        leaf = at - inner
        value = -RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + RIDGE)
        total += value[leaf]
        trees.append((feature, threshold, value))
    return Forest(base, *(np.stack(a) for a in zip(*trees, strict=True)))


def _with_statistics(rows: DataFrame, kept: list[str]) -> DataFrame:
    schema = rows.select(*kept).schema.add("stats", ArrayType(DoubleType()))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        stats = pa.array([statistics(t or b"") for t in batch.column(len(kept)).to_pylist()], pa.list_(pa.float64()))
        return pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], stats], [*kept, "stats"])

    return rows.select(*kept, F.col("text").cast("binary").alias("text")).mapInArrow(by_slice(work), schema)


def train(docs: DataFrame, labels: DataFrame) -> Forest:
    """Forest learned from a bounded sample of the labelled rows that are not held out.

    Of the labels' doc_ids, the TRAIN_ROWS with the lowest hash are taken; a doc_id labelled twice counts with its
    larger label. Null labels and null ids are not used.
    """
    usable = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~is_in_fold(*HELD_OUT))
    picked = usable.groupBy("doc_id").agg(F.max("quality").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS)
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    got = sorted((r.doc_id, r.y, r.stats) for r in _with_statistics(sample, ["doc_id", "y"]).collect())
    return fit(np.array([r[2] for r in got]).reshape(-1, len(FEATURES)), np.array([r[1] for r in got], float))


def score(docs: DataFrame, forest: Forest) -> DataFrame:
    """doc_id, score (probability of label 1) and predicted (1 if score is at least one half) of every whole text.

    docs: doc_id, text; further columns are ignored. Null texts are scored like empty ones, repeated rows each; an
    empty table gives an empty result. No shuffle.
    """
    schema = docs.select("doc_id").schema.add("score", "double").add("predicted", "integer")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        p = forest.score(np.array([statistics(t or b"") for t in batch.column(1).to_pylist()]).reshape(-1, len(FEATURES)))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(by_slice(work), schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    got = score(docs, train(docs, labels))
    return got.select("doc_id", is_in_fold(*HELD_OUT).alias("held_out"), "score", "predicted")
