"""Benchmark decontamination by a generalised suffix automaton of the normalised test items.

Words of a text are streamed through the automaton, which knows the longest item passage that ends at each word. Spans
whose match reaches a window (10 item words, or a whole shorter item) are hit and can be removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.automaton import SuffixAutomaton
from ledgerlake.llm.common import by_slice, keyed, same_doc, stash

WINDOW = 10
#: Bytes of items in one automaton, some 100 MB in a worker; larger benchmarks are streamed against in several blocks.
BLOCK_BYTES = 1_000_000
#: Lower-cases A-Z and blanks every other ASCII byte that is neither digit nor letter.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


class Matcher:
    """Finds the windows of items in texts."""

    def __init__(self, items: tuple[tuple[str, bytes], ...], window: int):
        self.window = window
        split = [(name, text.translate(NORMAL).split()) for name, text in items]
        self.vocab: dict[bytes, int] = {}
        coded = [(name, [self.vocab.setdefault(w, len(self.vocab) + 1) for w in ws]) for name, ws in split if ws]
        self.least = min((min(len(ws), window) for _, ws in coded), default=0)
        self.auto = auto = SuffixAutomaton(ws for _, ws in coded)
        #: Items that have the window, or the short item, of a state; its length in words.
        self.items: dict[int, set[str]] = {}
        self.size: dict[int, int] = {}
        for name, ws in coded:
            state = matched = 0
            for i, w in enumerate(ws):
                state, matched = auto.step(state, matched, w)
                n = window if matched >= window else len(ws) if i == len(ws) - 1 else 0
                if n:
                    while auto.length[auto.link[state]] >= n:
                        state = auto.link[state]
                    matched = min(matched, auto.length[state])
                    self.items.setdefault(state, set()).add(name)
                    self.size[state] = n
        #: Nearest state with items at or above each state, by suffix links; 0 if none.
        self.near = [0] * len(auto.link)
        for v in sorted(range(1, len(auto.link)), key=auto.length.__getitem__):
            self.near[v] = v if v in self.items else self.near[auto.link[v]]

    def find(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, hit spans of words (start, end), names of the items found."""
        words = text.translate(NORMAL).split()
        if not self.least or len(words) < self.least:
            return len(words), [], set()
        get = self.vocab.get
        ids = [get(w, 0) for w in words]
        known = np.frombuffer(bytes(map(bool, ids)), np.uint8)
        edge = np.flatnonzero(np.diff(np.r_[0, known, 0].astype(np.int8)))
        spans: list[tuple[int, int]] = []
        names: set[str] = set()
        long = edge[1::2] - edge[::2] >= self.least
        auto = self.auto
        for lo, hi in zip(edge[::2][long].tolist(), edge[1::2][long].tolist(), strict=True):
            state = matched = 0
            for j in range(lo, hi):
                state, matched = auto.step(state, matched, ids[j])
                v = self.near[state]
                while v:
                    n = self.size[v]
                    if n <= matched:
                        names |= self.items[v]
                        start = j + 1 - n
                        while spans and spans[-1][1] >= start:
                            start = min(start, spans.pop()[0])
                        spans.append((start, j + 1))
                    v = self.near[auto.link[v]]
        return len(words), spans, names


@lru_cache(maxsize=1)
def matcher(items: tuple[tuple[str, bytes], ...], window: int) -> Matcher:
    return Matcher(items, window)


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """Text without the words of the spans; what stands around a span is joined by one space."""
    flat = np.frombuffer(text.translate(NORMAL), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.r_[0, flat, 0].astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    out, at = [], 0
    for lo, hi in spans:
        out.append(text[at : start[lo]].rstrip())
        at = int(end[hi - 1])
    out.append(text[at:].lstrip())
    return b" ".join(x for x in out if x)


def _blocks(benchmark: DataFrame) -> tuple[int, Iterator[tuple[tuple[str, bytes], ...]]]:
    """How many blocks there are, and each in turn; the driver holds one at a time."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), F.col("text").cast("binary").alias("text")).filter("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))
    part = F.pmod(F.xxhash64("name", "text"), F.lit(n))
    return n, (tuple(sorted((r.name, bytes(r.text)) for r in items.filter(part == k).collect())) for k in range(n))


def _match(rows: DataFrame, items: tuple[tuple[str, bytes], ...], window: int) -> DataFrame:
    """doc_id, tid, n_words, spans and items of each of rows, those of :func:`keyed`, for one block."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = matcher(items, window)
        n, spans, names = zip(*[m.find(t or b"") for t in batch.column(2).to_pylist()], strict=True)
        flat = pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
        cols = [batch.column(0), batch.column(1), pa.array(n, pa.int64()), flat, pa.array([sorted(x) for x in names], pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "tid", "n_words", "spans", "items"])

    return rows.mapInArrow(by_slice(work), f"doc_id {kind}, tid bigint, n_words bigint, spans array<struct<start:int,end:int>>, items array<string>")


def _hits(docs: DataFrame, blocks: Iterator[tuple[tuple[str, bytes], ...]], window: int) -> DataFrame:
    """One row for each hit document, with the spans and items of all blocks; each block meets the whole texts."""
    both = None
    for items in blocks:
        found = stash(_match(keyed(docs), items, window).filter(F.size("spans") > 0), "hits")
        both = found if both is None else both.unionByName(found)
    spans = F.array_sort(F.flatten(F.collect_set("spans")))
    joined = F.aggregate(
        spans,
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda done, x: F.when((F.size(done) > 0) & (F.element_at(done, -1)["end"] >= x["start"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end"))))).otherwise(F.concat(done, F.array(x))),
    )
    return both.groupBy("doc_id", "tid").agg(joined.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Benchmark passages in every whole text.

    docs: doc_id, text; benchmark: item_id, text; further columns of either are ignored. Returns for each row of docs
    doc_id, tid, n_words (long), spans (array of start and end word, in order, not touching) and items (sorted array
    of item ids as text; a null id counts as the empty string). Null and empty texts have no words; items without
    words match nothing; repeated items count once; an empty benchmark gives no spans. The benchmark is read in blocks
    of BLOCK_BYTES, each streamed against all rows, so no automaton outgrows a worker; the hits of several blocks are
    written and joined to the rows. With one block, as for usual benchmarks, nothing is shuffled.
    """
    n, blocks = _blocks(benchmark)
    if n == 1:
        return _match(keyed(docs), next(blocks), window)
    hits, rows = _hits(docs, blocks, window), _match(keyed(docs), (), window).drop("spans", "items")
    none = [F.coalesce(hits[c], F.array().cast(hits.schema[c].dataType)).alias(c) for c in ("spans", "items")]
    return rows.join(hits, same_doc(rows, hits), "left").select(rows["doc_id"], rows["tid"], "n_words", *none)


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of the rows of :func:`find`."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.5) -> DataFrame:
    """docs without benchmark passages: hit spans are cut out; a text hit in over ``max_coverage`` of its words goes.

    All columns of docs are kept, in order; n_chars, if there, is counted anew where a text changed. Texts without a
    hit stay as they are, null and empty ones too. Every row of docs is judged by itself, repeated ones alike.
    """
    names, (n, blocks) = docs.columns, _blocks(benchmark)
    at = names.index("text")
    items = next(blocks) if n == 1 else ()
    rows = docs
    if n > 1:
        hits = _hits(docs, blocks, window).select(F.col("doc_id").alias("__of"), F.col("tid").alias("__tid"), F.col("spans").alias("__spans"))
        rows = docs.join(hits, docs["doc_id"].eqNullSafe(hits["__of"]) & (F.xxhash64(docs["text"]) == hits["__tid"]), "left").drop("__of", "__tid")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [None if t is None else t.encode() for t in batch.column(at).to_pylist()]
        m = matcher(items, window)
        keep, changed = [True] * len(texts), [False] * len(texts)
        known = [[(x["start"], x["end"]) for x in r or ()] for r in batch.column(len(names)).to_pylist()] if n > 1 else None
        for i, t in enumerate(texts):
            words, spans, _ = m.find(t or b"")
            spans = known[i] if known else spans
            if spans:
                keep[i] = sum(b - a for a, b in spans) <= max_coverage * words
                texts[i] = cut(t, spans)
                changed[i] = True
        cols = list(batch.columns[: len(names)])
        cols[at] = pa.array([None if t is None else t.decode() for t in texts], pa.string())
        return pa.RecordBatch.from_arrays([*cols, pa.array(changed)], [*names, "__changed"]).filter(pa.array(keep))

    out = rows.mapInArrow(by_slice(work), docs.select(*names).schema.add("__changed", "boolean"))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("__changed"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*names)
