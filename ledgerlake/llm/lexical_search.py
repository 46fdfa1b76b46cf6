"""Ranked lexical search by Block-Max MaxScore over shards of an inverted index.

1. Texts are split into terms once; of each shard of documents, the postings of all asked terms are written, with what
   the statistics need. Counts over the whole corpus come from these.
2. The index: postings in blocks, as narrow gaps and frequencies, with the greatest impact of each block and list.
3. Search: in each shard, the bounds of an item's lists tell the essential ones, without which no document can reach the
   k-th score. Their postings give the candidates; on the other lists, block maxima reject candidates before a block is
   decompressed. An item's best carry over from shard to shard of a task, and the tasks' heaps are merged.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import shards, stash
from ledgerlake.llm.threshold_search import MOST, Best

#: Documents of a shard, postings of a block.
SHARD, BLOCK = 4096, 64
#: Shards of a task, where there are more than two tasks for each core.
TASK = 64
#: Bytes of items that are searched for at once; the driver holds one such part of the items.
ITEM_BYTES = 1_000_000
#: Lower-cases A-Z and blanks every other ASCII byte that is neither digit nor letter.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
FOUND = "key int, item_id bigint, doc_id bigint, score bigint"


def terms(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def postings(docs: DataFrame, vocab: dict[bytes, int]) -> DataFrame:
    """A row for each shard: ids and lengths of its documents, and the postings of the terms of ``vocab``, term by term.

    texts and length: how many documents have a term at all, and all their terms with repeats. terms, dfs: those of
    vocab that the shard holds, and in how many documents; docs, tfs: place and frequency of each posting.
    """
    width = max(1, len(vocab))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocab.get
        for _, batch in shards(batches, SHARD):
            lengths, keys = np.zeros(batch.num_rows, np.int64), []
            for i, text in enumerate(batch.column(1)):
                words = terms(text.as_buffer().to_pybytes()) if text.is_valid else []
                lengths[i] = len(words)
                known = np.array([t for t in map(get, words) if t is not None], np.int64)
                if len(known):
                    keys.append(known * SHARD + i)
            key, tf = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
            term, df = np.unique(key // SHARD, return_counts=True)
            cols = [batch.column(0).to_pylist(), lengths.tobytes(), int((lengths > 0).sum()), int(lengths.sum()), term.tolist(), df.tolist(), (key % SHARD).astype(np.uint16).tobytes(), tf.astype(np.int32).tobytes()]
            types = [pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cols, types, strict=True)], ["ids", "lengths", "texts", "length", "terms", "dfs", "docs", "tfs"])

    assert width < 2**47  # a posting's key holds its term and its place
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(work, "ids array<bigint>, lengths binary, texts bigint, length bigint, terms array<int>, dfs array<int>, docs binary, tfs binary")


def _narrow(x: np.ndarray) -> tuple[int, bytes]:
    """Numbers in as few bytes each as the largest needs."""
    kind = np.uint8 if x.max() < 1 << 8 else np.uint16 if x.max() < 1 << 16 else np.uint32
    return kind().itemsize, x.astype(kind).tobytes()


def impacts(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * norm)


def index(posted: DataFrame, texts: int, length: int, size: int) -> DataFrame:
    """The index of each shard of :func:`postings`, in blocks of ``size`` postings.

    norms: of each document. For each list its term, number of postings, and bytes of a gap and of a frequency; for each
    block its first and last document and its greatest impact; then all gaps and all frequencies, list by list.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                norm = 25 + 75 * np.frombuffer(row["lengths"], np.int64) * texts // length
                docs, tf = np.frombuffer(row["docs"], np.uint16).astype(np.int64), np.frombuffer(row["tfs"], np.int32).astype(np.int64)
                impact = impacts(tf, norm[docs])
                df = np.array(row["dfs"], np.int64)
                ends = np.cumsum(df)
                place = np.arange(len(docs)) - np.repeat(ends - df, df)
                starts = np.flatnonzero(place % size == 0)
                gap = np.diff(docs, prepend=0)
                gap[starts] = 0
                most = np.maximum.reduceat(impact, starts) if len(starts) else impact
                last = docs[np.r_[starts[1:], len(docs)] - 1] if len(starts) else docs
                gaps, tfs = [[_narrow(x[e - d : e]) for e, d in zip(ends.tolist(), df.tolist(), strict=True)] for x in (gap, tf)]
                meta = np.array([row["terms"], row["dfs"], [w for w, _ in gaps], [w for w, _ in tfs]], np.int32)
                blocks = np.array([docs[starts], last, most], np.int32)
                cols = [pa.array([row["ids"]], pa.list_(pa.int64())), *(pa.array([b], pa.binary()) for b in (norm.tobytes(), meta.tobytes(), blocks.tobytes(), b"".join(b for _, b in gaps), b"".join(b for _, b in tfs)))]
                yield pa.RecordBatch.from_arrays(cols, ["ids", "norms", "meta", "blocks", "gaps", "tfs"])

    return posted.select("ids", "lengths", "terms", "dfs", "docs", "tfs").mapInArrow(work, "ids array<bigint>, norms binary, meta binary, blocks binary, gaps binary, tfs binary")


WIDTHS = {1: np.uint8, 2: np.uint16, 4: np.uint32}


class Shard:
    """The lists of one shard's index; ``read`` counts the blocks that were decompressed."""

    def __init__(self, size: int, ids: pa.Array, norms: bytes, meta: bytes, blocks: bytes, gaps: bytes, tfs: bytes):
        self.size = size
        self.ids, self.none = ids.fill_null(MOST).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
        self.norm = np.frombuffer(norms, np.int64)
        term, self.df, self.gap_width, self.tf_width = np.frombuffer(meta, np.int32).reshape(4, -1).astype(np.int64)
        self.list_of = {t: i for i, t in enumerate(term.tolist())}
        self.first, self.last, self.most = np.frombuffer(blocks, np.int32).reshape(3, -1).astype(np.int64)
        self.gaps, self.tfs = gaps, tfs
        ahead = lambda x: np.r_[0, np.cumsum(x)]
        self.gap_at, self.tf_at, self.block_at = ahead(self.df * self.gap_width), ahead(self.df * self.tf_width), ahead(-(-self.df // size))
        self.highest = np.maximum.reduceat(self.most, self.block_at[:-1]) if len(term) else self.most
        self.acc = np.zeros(len(self.norm), np.int64)
        self.read = 0

    def postings(self, i: int, blocks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of a list, or of some of its blocks."""
        n = int(self.df[i])
        gap = np.frombuffer(self.gaps, WIDTHS[int(self.gap_width[i])], n, int(self.gap_at[i]))
        tf = np.frombuffer(self.tfs, WIDTHS[int(self.tf_width[i])], n, int(self.tf_at[i]))
        first = self.first[self.block_at[i] : self.block_at[i + 1]]
        if blocks is not None and len(blocks) < len(first):
            at = (blocks[:, None] * self.size + np.arange(self.size)).ravel()
            at = at[at < n]  # only a list's last block is short
            gap, tf, first = gap[at], tf[at], first[blocks]
        self.read += len(first)
        far = np.cumsum(gap, dtype=np.int64)
        base = first - far[:: self.size]
        docs = far + np.repeat(base, self.size)[: len(far)]
        return docs, impacts(tf.astype(np.int64), self.norm[docs])

    def search(self, asked: list[tuple[int, int]], best: Best) -> None:
        """Adds to ``best`` what the shard has for an item; asked: its terms and their weights, times their repeats."""
        lists = sorted((weight * int(self.highest[i]), i, weight) for t, weight in asked if weight and (i := self.list_of.get(t)) is not None)
        if not lists:
            return
        bound = np.cumsum([b for b, _, _ in lists]).tolist()
        floor = best.floor() or 1  # a document that cannot reach it is passed over; equal scores are decided by id
        essential = next((k for k, b in enumerate(bound) if b >= floor), len(lists))
        acc = self.acc
        acc[:] = 0
        for _, i, weight in lists[essential:]:
            docs, impact = self.postings(i)
            acc[docs] += weight * impact
        near = np.flatnonzero(acc)
        for k in range(essential - 1, -1, -1):
            near = near[acc[near] + bound[k] >= floor]
            if not len(near):
                return
            _, i, weight = lists[k]
            lo, hi = int(self.block_at[i]), int(self.block_at[i + 1])
            block = np.searchsorted(self.first[lo:hi], near, side="right") - 1
            inside = (block >= 0) & (near <= self.last[lo + np.maximum(block, 0)])
            at_most = np.where(inside, weight * self.most[lo + np.maximum(block, 0)], 0)
            reach = acc[near] + at_most + (bound[k - 1] if k else 0) >= floor
            near, block = near[reach], np.unique(block[reach & inside])
            if len(block):
                docs, impact = self.postings(i, block)
                acc[docs] += weight * impact
        score = acc[near]
        some = score >= floor
        best.add(score[some], self.ids[near[some]], self.none[near[some]])


def _searched(indexed: DataFrame, items: list[tuple[int, int | None, list[tuple[int, int]]]], k: int, size: int) -> DataFrame:
    """Each task's k best documents for every item."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, some = [Best(k) for _ in items], False
        for batch in batches:
            for row in (batch.slice(i, 1) for i in range(batch.num_rows)):
                some = True
                shard = Shard(size, row.column(0).flatten(), *(row.column(c)[0].as_py() for c in range(1, 6)))
                for (_, _, asked), b in zip(items, best, strict=True):
                    shard.search(asked, b)
        if some:
            of = np.repeat(np.arange(len(items)), [len(b.score) for b in best]).tolist()
            found = pa.array(np.concatenate([b.id for b in best]), mask=np.concatenate([b.none for b in best]))
            cols = [pa.array([items[i][0] for i in of], pa.int32()), pa.array([items[i][1] for i in of], pa.int64()), found, pa.array(np.concatenate([b.score for b in best]))]
            yield pa.RecordBatch.from_arrays(cols, ["key", "item_id", "doc_id", "score"])

    return indexed.mapInArrow(work, FOUND)


def _part(docs: DataFrame, items: list[tuple[int | None, bytes]], k: int) -> DataFrame | None:
    """The k best documents for each of some items; None where no document has a term."""
    counts = [Counter(terms(text)) for _, text in items]
    vocab = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
    posted = stash(postings(docs, vocab), "postings")
    n, length = posted.agg(F.sum("texts"), F.sum("length")).first()
    if not n:
        return None
    indexed = stash(index(posted, n, length, BLOCK), "index")
    df = posted.select(F.explode(F.arrays_zip("terms", "dfs")).alias("t")).groupBy("t.terms").agg(F.sum("t.dfs").alias("df"))
    weight = {r.terms: int(np.floor(1000 * np.log((2 * n + 2) / (2 * r.df + 1)))) for r in df.collect()}  # as many as the items have terms
    asked = [(key, name, [(vocab[t], weight[vocab[t]] * m) for t, m in c.items() if vocab[t] in weight]) for key, ((name, _), c) in enumerate(zip(items, counts, strict=True))]
    shards_ = indexed.count()  # the index is so compact that its files would make few tasks
    tasks = max(1, min(shards_, max(2 * docs.sparkSession.sparkContext.defaultParallelism, shards_ // TASK)))
    found = _searched(indexed.repartition(tasks), asked, k, BLOCK)
    order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, benchmark: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (int, from 1), doc_id and score (long): the k best documents for each item, with scores above 0.

    docs: doc_id, text; benchmark: item_id, text; further columns of either are ignored. Terms are stretches of ASCII
    letters and digits and of other characters, A-Z in lower case. Equal scores go by doc_id, null ids last. Null and
    empty texts have no terms and are in no ranking; items without terms, or whose terms no document has, have no rows.
    Rows of docs are documents of their own, repeated ones too; repeated rows of benchmark are one item, and an id with
    several texts is ranked for each. The benchmark is searched for in parts of ITEM_BYTES; all documents are indexed
    for each. Postings and index are written tables.
    """
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("binary").alias("text")).filter("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // ITEM_BYTES))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    out = None
    for p in range(n):
        rows = sorted(((r.item_id, bytes(r.text)) for r in items.filter(part == p).collect()), key=lambda x: (x[0] is None, x[0], x[1]))
        found = _part(docs, rows, k) if rows else None
        if found is not None:
            found = stash(found, "ranked") if n > 1 else found
            out = found if out is None else out.unionByName(found)
    return out if out is not None else docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
