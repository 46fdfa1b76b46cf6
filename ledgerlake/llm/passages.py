"""Repeated windows of a corpus: how suffix-array and substring deduplication split a corpus into groups for tasks.

1. Anchored runs of windows (see :mod:`anchors`) are written once and grouped by anchor and content; runs with equal
   content are settled by their 128-bit digest.
2. Where an anchor has several contents, one of each is fetched. An anchor's contents go to one task, which finds the
   windows that repeat among them by the operator's own method, on the symbols themselves. Where they are too many for a
   task, the windows are grouped instead, by 128-bit digest, summed up in each task first.
3. What was found is joined to the documents.

Rows that agree in doc_id and in a 64-bit hash of the text are one document. Intermediate tables are written, and removed
once the next one is there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.anchors import runs
from ledgerlake.llm.common import by_slice, forget, join_counted, keyed, stash, tid_of

#: Symbols' identifiers, sequence ends, bytes, and where each symbol starts and stops in them.
Laid = tuple[np.ndarray, np.ndarray, bytes, np.ndarray, np.ndarray]
#: Row, place in the row, and bucket of each window that shares its bucket; equal windows have equal buckets.
Buckets = tuple[np.ndarray, np.ndarray, np.ndarray]
#: Bits of an anchor's identifier that are shuffled.
ANCHOR = np.uint64((1 << 48) - 1)
#: Rows of documents worked on at once, and bytes of run contents.
ROWS, CONTENT_BYTES = 300, 2_000_000
#: Anchors up to which they are broadcast, 16 bytes each; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
LAST = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Kind:
    """What a symbol is, and how long grams and windows are."""

    lay: Callable[[list[bytes]], Laid]
    #: The symbols of a text from each given start, so many each.
    cut: Callable[[bytes, list[tuple[int, int]]], list[bytes]]
    #: The windows of some contents that repeat among them, in buckets.
    buckets: Callable[[list[bytes], int], Buckets]
    gram: int
    window: int
    #: Whether the earliest occurrence of a window is spared.
    spare_first: bool
    #: Contents of one anchor that one task compares; with more, the windows are grouped instead.
    group: int


def with_keys(docs: DataFrame) -> DataFrame:
    """doc_id, tid and the text's bytes."""
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return keyed(ids, tid_of(ids))


def _runs(texts: DataFrame, kind: Kind) -> DataFrame:
    """A row for each run: its document, anchor, digest of its content, first window start, and windows."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams, ends, buf, starts, stops = kind.lay([t or b"" for t in batch.column(2).to_pylist()])
        begin = np.r_[0, ends[:-1]]
        out = [[] for _ in range(6)]
        digest = xxhash.xxh3_128_digest
        for of, p, lo, hi in runs(grams, kind.gram, kind.window, ends):
            d = b"".join([digest(buf[a:b]) for a, b in zip(starts[lo].tolist(), stops[hi + kind.window - 1].tolist(), strict=True)])
            d = np.frombuffer(d, "<i8").reshape(-1, 2)
            for o, x in zip(out, (of, (grams[p] & ANCHOR).astype(np.int64), d[:, 0], d[:, 1], (lo - begin[of]).astype(np.int32), (hi - lo + 1).astype(np.int32)), strict=True):
                o.append(x)
        of, *cols = (np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(out, ("i8", "i8", "i8", "i8", "i4", "i4"), strict=True))
        take = pa.array(of)
        return pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), *map(pa.array, cols)], ["doc_id", "tid", "a", "h1", "h2", "lo", "n"])

    return texts.mapInArrow(by_slice(work, ROWS), "doc_id bigint, tid bigint, a bigint, h1 bigint, h2 bigint, lo int, n int")


def _fetch(texts: DataFrame, reps: DataFrame, kind: Kind) -> DataFrame:
    """a, doc_id, tid, lo, occurs, kinds and the content of each run in reps; a document goes once, with all its runs."""
    lists = reps.groupBy(F.col("doc_id").alias("d"), F.col("tid").alias("t")).agg(F.collect_list(F.struct("a", "lo", "n", "occurs", "kinds")).alias("runs"))
    joined = texts.join(lists, texts["doc_id"].eqNullSafe(lists["d"]) & (texts["tid"] == lists["t"])).select("doc_id", "tid", "text", "runs")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        of, marks, content = [], [], []
        for i, (text, rs) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
            of += [i] * len(rs)
            marks += rs
            content += kind.cut(text, [(r["lo"], r["n"] + kind.window - 1) for r in rs])
        take = pa.array(of, pa.int64())
        cols = [pa.array([m[c] for m in marks], t) for c, t in (("a", pa.int64()), ("lo", pa.int32()), ("occurs", pa.int64()), ("kinds", pa.int64()))]
        return pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), *cols, pa.array(content, pa.binary())], ["doc_id", "tid", "a", "lo", "occurs", "kinds", "content"])

    return joined.mapInArrow(by_slice(work, ROWS), "doc_id bigint, tid bigint, a bigint, lo int, occurs bigint, kinds bigint, content binary")


def _ranges(table: pa.Table, row: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Windows, in order, as ranges of window starts in their documents."""
    at = place + table.column("lo").to_numpy()[row]
    edge = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)]) if len(row) else np.zeros(0, int)
    last = np.r_[edge[1:], len(row)] - 1 if len(row) else edge
    take = pa.array(row[edge], pa.int64())
    whole = table.combine_chunks()
    return pa.RecordBatch.from_arrays([whole.column("doc_id").combine_chunks().take(take), whole.column("tid").combine_chunks().take(take), pa.array(at[edge].astype(np.int32)), pa.array(at[last].astype(np.int32))], ["doc_id", "tid", "lo", "hi"])


def _compare(table: pa.Table, kind: Kind) -> pa.RecordBatch:
    """Windows that repeat among the contents of table's anchors; equal windows have one anchor, so all go together."""
    row, place, bucket = kind.buckets(table.column("content").to_pylist(), kind.window)
    if kind.spare_first:  # repeated rows are one document: all of them hold its first occurrence
        doc, tid = table.column("doc_id").fill_null(LAST).to_numpy()[row], table.column("tid").to_numpy()[row]
        start = place + table.column("lo").to_numpy()[row]
        order = np.lexsort((tid, start, doc, bucket))
        same = bucket[order][1:] == bucket[order][:-1]
        first = order[np.maximum.accumulate(np.r_[0, np.where(same, 0, np.arange(1, len(order)))])[: len(order)]]
        marked = np.zeros(len(row), bool)
        marked[order] = (doc[order] != doc[first]) | (start[order] != start[first]) | (tid[order] != tid[first])
    else:  # runs met more than once are settled already
        marked = table.column("occurs").to_numpy()[row] == 1
    row, place = row[marked], place[marked]
    order = np.lexsort((place, row))
    return _ranges(table, row[order], place[order])


def _bucketed(contents: DataFrame, kind: Kind) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.column("content").nbytes
            if size >= CONTENT_BYTES:
                table = pa.Table.from_batches(held).combine_chunks()
                a = table.column("a").to_numpy()
                cut = len(a) - int(np.argmax((a != a[-1])[::-1])) if a[0] != a[-1] else 0
                if cut:
                    yield _compare(table.slice(0, cut), kind)
                    held = table.slice(cut).to_batches()
                    size = sum(b.column("content").nbytes for b in held)
        if held:
            yield _compare(pa.Table.from_batches(held).combine_chunks(), kind)

    sorted_rows = contents.repartition("a").sortWithinPartitions("a")
    return sorted_rows.mapInArrow(_small(work), "doc_id bigint, tid bigint, lo int, hi int")


def _small(work):
    """``work`` on slices of the batches that Spark hands over."""
    return lambda batches: work(b.slice(k, 500) for b in batches for k in range(0, b.num_rows, 500))


def _grouped(contents: DataFrame, kind: Kind) -> DataFrame:
    """The same for anchors with too many contents for one task: each window is a row, grouped by its own digest."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, ends, buf, starts, stops = kind.lay(batch.column("content").to_pylist())
        size = np.diff(np.r_[0, ends]) - kind.window + 1
        row = np.repeat(np.arange(len(ends)), size)
        place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        at = place + np.r_[0, ends[:-1]][row]
        d = b"".join([xxhash.xxh3_128_digest(buf[a:b]) for a, b in zip(starts[at].tolist(), stops[at + kind.window - 1].tolist(), strict=True)])
        d, take = np.frombuffer(d, "<i8").reshape(-1, 2).T.copy(), pa.array(row, pa.int64())
        s = (place + batch.column("lo").to_numpy()[row]).astype(np.int32)
        return pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in ("doc_id", "tid", "occurs")), pa.array(s), *map(pa.array, d)], ["doc_id", "tid", "occurs", "lo", "w1", "w2"])

    rows = contents.select("doc_id", "tid", "occurs", "lo", "content").mapInArrow(by_slice(work, ROWS), "doc_id bigint, tid bigint, occurs bigint, lo int, w1 bigint, w2 bigint")
    place = F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("d"), F.col("lo").alias("s"), F.col("tid").alias("t"))
    again = rows.groupBy("w1", "w2").agg(F.count("*").alias("m"), F.min(place).alias("first")).filter("m > 1")
    found = rows.join(again, ["w1", "w2"])
    found = found.filter(place != F.col("first")) if kind.spare_first else found.filter("occurs = 1")
    return found.select("doc_id", "tid", "lo", F.col("lo").alias("hi"))


def repeated(texts: DataFrame, kind: Kind) -> DataFrame:
    """doc_id, tid and ranges, the window starts to be marked, of every document of :func:`with_keys` that has some."""
    found = stash(_runs(texts, kind), "runs")
    place = F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("d"), "lo", "tid", "n")
    kinds = stash(found.groupBy("a", "h1", "h2").agg(F.count("*").alias("occurs"), F.min(place).alias("first")), "kinds")
    several = stash(kinds.groupBy("a").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "anchors")
    small = several.count() <= BROADCAST_ROWS
    notable = kinds.join(F.broadcast(several) if small else several, "a", "left").select("a", "h1", "h2", "occurs", F.coalesce("kinds", F.lit(1)).alias("kinds"), "first")
    notable = stash(notable.filter("occurs > 1 or kinds > 1"), "notable")
    forget(kinds)
    forget(several)
    again = notable.filter("occurs > 1").select("h1", "h2", "occurs", F.col("first.d").alias("d"), F.col("first.lo").alias("s"), F.col("first.tid").alias("t"))
    settled = join_counted(found.drop("a"), again, ["h1", "h2"], "occurs")
    if kind.spare_first:
        settled = settled.filter((F.coalesce("doc_id", F.lit(LAST)) != F.col("d")) | (F.col("lo") != F.col("s")) | (F.col("tid") != F.col("t")))
    settled = stash(settled.select("doc_id", "tid", "lo", (F.col("lo") + F.col("n") - 1).alias("hi")), "settled")
    forget(found)
    doc = F.when(F.col("first.d") != LAST, F.col("first.d")).alias("doc_id")
    reps = notable.filter("kinds > 1").select("a", "occurs", "kinds", doc, *[F.col(f"first.{c}").alias(c) for c in ("tid", "lo", "n")])
    contents = _fetch(texts, reps, kind)
    if reps.filter(F.col("kinds") > kind.group).isEmpty():
        within = _bucketed(contents, kind)
    else:
        contents = stash(contents, "contents")
        hot = F.col("kinds") > kind.group
        within = _bucketed(contents.filter(~hot), kind).unionByName(_grouped(contents.filter(hot), kind))
    marks = settled.unionByName(within)
    ranges = stash(marks.groupBy("doc_id", "tid").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")), "ranges")
    for table in (notable, settled):
        forget(table)
    return ranges


def with_ranges(docs: DataFrame, kind: Kind) -> DataFrame:
    """doc_id, text (its bytes) and ranges of repeated windows (null if none) for every row of docs."""
    texts = with_keys(docs)
    marks = repeated(texts, kind).select(F.col("doc_id").alias("d"), F.col("tid").alias("t"), "ranges")
    return texts.join(marks, texts["doc_id"].eqNullSafe(marks["d"]) & (texts["tid"] == marks["t"]), "left").select("doc_id", F.coalesce("text", F.lit(b"")).alias("text"), "ranges")


def covered(ranges: list[dict] | None, window: int, size: int) -> list[tuple[int, int]]:
    """Maximal stretches of symbols that the windows at ``ranges`` cover."""
    out: list[list[int]] = []
    for lo, hi in sorted((r["lo"], r["hi"]) for r in ranges or ()):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], min(size, hi + window))
        else:
            out.append([lo, min(size, hi + window)])
    return [(a, b) for a, b in out]
