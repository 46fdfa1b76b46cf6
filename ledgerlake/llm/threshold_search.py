"""Exact top-k inner-product search by Fagin's threshold algorithm.

Vectors are packed into shards, each with one list for every component: the shard's vectors in order of that component.
A query walks the lists of its components from their best end, scores in full whatever it meets, and stops in a shard as
soon as the bound on all vectors not yet met, the sum of the lists' next values, cannot reach its k-th result. Results
carry over from shard to shard of a task, so later shards are left early; the tasks' results are merged at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import shards, stash

#: A component x counts as floor(SCALE * x).
SCALE = 1024
#: Vectors of a shard, and queries that are searched for at once; the driver holds one such block of queries.
SHARD, BLOCK = 4096, 2048
#: Places of each list that are read at first; doubled until the bound is too low.
DEPTH = 32
#: Sums below this are exact in doubles.
EXACT = 2**53
LEAST, MOST = -(2**63), 2**63 - 1
FOUND = "qs bigint, qp int, query_id bigint, vec_id bigint, score bigint"


def pack(embeddings: DataFrame, asks: Column) -> DataFrame:
    """A row for each shard: its number, ids, which rows are queries, components (rows by components), and sorted lists.

    ``lists`` has, for every component, the places of the vectors in ascending order of it. A vector that is null or has a
    null or non-finite component takes no part; shorter vectors are filled up with zeros.
    """
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.coalesce(asks, F.lit(False)).alias("asks"), F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("v"), bad.alias("bad"))
    rows = rows.filter("v is not null and not bad").drop("bad")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in shards(batches, SHARD):
            sizes = batch.column(2).value_lengths().to_numpy()
            x = np.zeros((len(sizes), max(1, sizes.max())), np.int64)
            x[np.arange(x.shape[1]) < sizes[:, None]] = batch.column(2).flatten().to_numpy()
            lists = np.argsort(x.T, axis=1, kind="stable").astype(np.int32)
            cols = [[number], [batch.column(0).to_pylist()], [batch.column(1).to_pylist()], [x.shape[1]], [x.tobytes()], [lists.tobytes()]]
            types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["shard", "ids", "asks", "dims", "vectors", "lists"])

    return rows.mapInArrow(work, "shard bigint, ids array<bigint>, asks array<boolean>, dims int, vectors binary, lists binary")


def queries(packed: DataFrame) -> DataFrame:
    """qs, qp, query_id, vector: the queries among the vectors, by their shard and place."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = [i for i, asks in enumerate(row["asks"]) if asks]
                x = np.frombuffer(row["vectors"], np.int64).reshape(-1, row["dims"])
                yield pa.RecordBatch.from_arrays([pa.array([row["shard"]] * len(at), pa.int64()), pa.array(at, pa.int32()), pa.array([row["ids"][i] for i in at], pa.int64()), pa.array([x[i].tolist() for i in at], pa.list_(pa.int64()))], ["qs", "qp", "query_id", "vector"])

    return packed.drop("lists").mapInArrow(work, "qs bigint, qp int, query_id bigint, vector array<bigint>")


class Best:
    """The k best results of a query so far: scores and ids; a null id comes last among equal scores."""

    def __init__(self, k: int):
        self.k = k
        self.score = np.zeros(0, np.int64)
        self.id = np.zeros(0, np.int64)
        self.none = np.zeros(0, bool)

    def floor(self) -> int | None:
        """The k-th score, if there are so many."""
        return int(self.score[-1]) if len(self.score) == self.k else None

    def add(self, score: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        if len(self.score) == self.k:
            near = score >= self.score[-1]
            score, ids, none = score[near], ids[near], none[near]
        if not len(score):
            return
        score, ids, none = np.r_[self.score, score], np.r_[self.id, ids], np.r_[self.none, none]
        order = np.lexsort((ids, none, -score))[: self.k] if score.dtype != object else np.array(sorted(range(len(score)), key=lambda i: (-score[i], none[i], ids[i]))[: self.k])
        self.score, self.id, self.none = score[order], ids[order], none[order]


def _fitted(x: np.ndarray, dims: int) -> np.ndarray:
    """Rows with ``dims`` components; what is missing is zero."""
    return x[:, :dims] if x.shape[1] >= dims else np.pad(x, ((0, 0), (0, dims - x.shape[1])))


def walk(asked: np.ndarray, own: np.ndarray, x: np.ndarray, lists: np.ndarray, ids: np.ndarray, none: np.ndarray, best: list[Best]) -> int:
    """The threshold algorithm for some queries over one shard. Adds to ``best``; returns how many scores were computed.

    own: place of each query in the shard, -1 if it is not there.
    """
    n, dims = x.shape
    asked = _fitted(asked, dims)
    high = [int(abs(a.astype(object)).max(initial=0)) for a in (asked, x)]
    kind = np.float64 if high[0] * high[1] * dims < EXACT else object  # Python's numbers where doubles would round
    asked, x = asked.astype(kind), x.astype(kind)
    values = np.take_along_axis(x.T, lists, 1)
    up, down = np.where(asked > 0, asked, 0), np.where(asked < 0, asked, 0)
    met = np.zeros((len(asked), n), bool)
    met[own >= 0, own[own >= 0]] = True
    active, last, depth, scored = np.arange(len(asked)), 0, min(DEPTH, n), 0
    while len(active):
        for q in active.tolist():
            a = asked[q]
            if last == 0 and not a.any():  # no list to walk: every score is zero
                fresh = ~met[q]
            else:
                fresh = np.zeros(n, bool)
                fresh[lists[a > 0, n - depth : n - last]] = True
                fresh[lists[a < 0, last:depth]] = True
                fresh &= ~met[q]
            at = np.flatnonzero(fresh)
            met[q] |= fresh
            scored += len(at)
            found = x[at] @ a
            best[q].add(found if kind is object else found.astype(np.int64), ids[at], none[at])
        if depth == n:
            break
        bound = up[active] @ values[:, n - 1 - depth] + down[active] @ values[:, depth]
        floors = [best[q].floor() for q in active.tolist()]
        on = np.array([f is None or b >= f for f, b in zip(floors, bound.tolist(), strict=True)], bool)
        active = active[on & ~met[active].all(axis=1)]
        last, depth = depth, min(2 * depth, n)
    return scored


def _searched(packed: DataFrame, block: list, k: int) -> DataFrame:
    """Each task's k best for the queries of one block."""
    dims = max(len(r.vector) for r in block)
    asked = np.array([r.vector + [0] * (dims - len(r.vector)) for r in block], np.int64)
    qs, qp, names = np.array([r.qs for r in block], np.int64), np.array([r.qp for r in block], np.int32), [r.query_id for r in block]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, some = [Best(k) for _ in names], False
        for batch in batches:
            for row in (batch.slice(i, 1) for i in range(batch.num_rows)):
                some = True
                number, d = row.column(0)[0].as_py(), row.column(2)[0].as_py()
                x = np.frombuffer(row.column(3)[0].as_buffer(), np.int64).reshape(-1, d)
                lists = np.frombuffer(row.column(4)[0].as_buffer(), np.int32).reshape(d, -1)
                ids = row.column(1).flatten()
                walk(asked, np.where(qs == number, qp, -1), x, lists, ids.fill_null(MOST).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), best)
        if some:
            of = np.repeat(np.arange(len(names)), [len(b.score) for b in best])
            score = [min(MOST, max(LEAST, int(s))) for b in best for s in b.score]
            found = pa.array(np.concatenate([b.id for b in best]), mask=np.concatenate([b.none for b in best]))
            cols = [pa.array(qs[of]), pa.array(qp[of]), pa.array([names[i] for i in of.tolist()], pa.int64()), found, pa.array(score, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["qs", "qp", "query_id", "vec_id", "score"])

    return packed.select("shard", "ids", "dims", "vectors", "lists").mapInArrow(work, FOUND)


def search(embeddings: DataFrame, asks: Column, k: int = 10) -> DataFrame:
    """query_id, rank (int, from 1), vec_id and score (long): the k best of all other rows for each row that ``asks``.

    embeddings: vec_id, embedding (array of numbers); further columns are ignored. Score is the inner product of
    floor(1024 * component), an integer; equal scores go by vec_id, null ids last. Vectors that are null or hold a null or
    non-finite component take no part; a shorter vector counts as filled up with zeros, an empty one scores zero with
    all. Rows are told apart by their place: repeated ids are separate queries and candidates, and a row finds its
    copies but not itself. Components beyond 64 bits and scores beyond them are held at the 64-bit limits. No rows give
    none. Shards and queries are written once; queries are searched for in blocks of BLOCK, each against all shards.
    """
    spark = embeddings.sparkSession
    packed = stash(pack(embeddings, asks), "shards")
    asked = stash(queries(packed), "queries")
    n = -(-asked.count() // BLOCK)
    found = spark.createDataFrame([], FOUND)
    part = F.pmod(F.xxhash64("qs", "qp"), F.lit(max(1, n)))
    for b in range(n):
        block = asked.filter(part == b).collect()
        if block:
            hits = _searched(packed, block, k)
            found = found.unionByName(stash(hits, "hits") if n > 1 else hits) if b else (stash(hits, "hits") if n > 1 else hits)
    order = Window.partitionBy("qs", "qp").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
