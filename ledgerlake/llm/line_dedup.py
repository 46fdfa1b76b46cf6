"""Line deduplication over content-defined chunks of lines.

Texts are broken into short lines: at ``\n``, and at blanks that the bytes before them choose. A rolling hash over the
hashes of the last two lines chooses the boundaries of chunks of several lines, so an inserted line moves those around it
and no others. Chunks that occur more than once anywhere are removed but for their first occurrence, after their bytes
were compared.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import by_slice, forget, ids_repeat, join_counted, keyed, stash, tid_of

#: Blanks for each one that ends a line (1: every blank, so that repeats within long lines are found, and a line is a word),
#: and rolling hashes for each one that ends a chunk.
CUT, MEAN = 1, 3
#: Lines of a chunk at least, and lines from which any end is its end.
MIN_LINES, MAX_LINES = 3, 16
#: Bytes of a chunk at least; repeats shorter than that are everyday phrases, and stay.
MIN_BYTES = 24
#: Rows and bytes of documents whose lines a worker holds at once (or one longer text), and bytes that are hashed at once.
ROWS, SIZE, BLOCK = 250, 2_000_000, 1 << 19
#: Odd numbers by which bytes and hashes are mixed.
BYTES = (2654435761, 40503, 9973)
MIX, POLY = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def ends_line(data: np.ndarray) -> np.ndarray:
    """Whether each byte is a ``\n``, or a blank that the three bytes before it choose."""
    blank = (data == 32) | (data == 9)
    if CUT == 1:
        return (data == 10) | blank
    d = data.astype(np.uint32)
    h = np.zeros(len(d), np.uint32)
    for k, m in enumerate(BYTES, 1):
        h[k:] += d[:-k] * np.uint32(m)
    h = (h ^ h >> np.uint32(15)) * np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    return (data == 10) | (blank & (h % np.uint32(CUT) == 0))


#: Stands for a line of which it is not known yet where a chunk from it would end.
NOWHERE = np.iinfo(np.int64).min


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of POLY and of its inverse, modulo 2^64."""
    one = np.ones(1, np.uint64)
    return tuple(np.cumprod(np.r_[one, np.full(n - 1, x, np.uint64)]) for x in (POLY, pow(POLY, -1, 1 << 64)))


@dataclass
class Lines:
    """The lines of some texts, laid end to end in one buffer, each text with a ``\n`` after it."""

    buffer: bytes
    #: Where each text begins and ends, which text a line belongs to, and its bytes.
    begin: np.ndarray
    end: np.ndarray
    text: np.ndarray
    start: np.ndarray
    stop: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Lines:
        # three line breaks before each text, so that what stands before it has no say
        buffer = b"".join(b"\n\n\n" + x + b"\n" for x in texts)
        size = np.array([len(x) + 4 for x in texts], np.int64)
        end = np.cumsum(size) - 1
        begin = end + 4 - size
        at = np.flatnonzero(ends_line(np.frombuffer(buffer, np.uint8)))
        text = np.searchsorted(end, at)
        own = at >= begin[text] if len(texts) else at >= 0
        stop, text = at[own], text[own]
        first = np.r_[True, text[1:] != text[:-1]] if len(text) else np.zeros(0, bool)
        start = np.where(first, begin[text], np.r_[0, stop[:-1] + 1][: len(stop)]) if len(text) else stop
        return cls(buffer, begin, end, text, start, stop)

    def hashes(self) -> np.ndarray:
        """A polynomial hash of each line's bytes, from running sums over BLOCK bytes or a longer line at a time."""
        out, at, data = np.empty(len(self.stop), np.uint64), 0, np.frombuffer(self.buffer, np.uint8)
        while at < len(out):
            begin = int(self.start[at])
            after = max(at + 1, int(np.searchsorted(self.stop, begin + BLOCK, side="right")))
            part = data[begin : int(self.stop[after - 1])]
            power, back = _powers(max(BLOCK + 1, 1 << len(part).bit_length()))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part + np.uint64(1)) * power[: len(part)], out=sums[1:])
            start, stop = self.start[at:after] - begin, self.stop[at:after] - begin
            out[at:after] = (sums[stop] - sums[start]) * back[start]
            at = after
        return out

    def chunks(self, min_bytes: int) -> np.ndarray:
        """First line, and line after the last, of each chunk, text by text."""
        h = self.hashes()
        before = np.r_[np.zeros(min(1, len(h)), np.uint64), h[:-1]]
        before[np.searchsorted(self.text, np.unique(self.text))] = 0
        roll = h * np.uint64(3) + before * np.uint64(MIX)
        roll = (roll ^ roll >> np.uint64(29)) * np.uint64(MIX)
        last = self.stop == self.end[self.text]
        may = np.flatnonzero(((roll >> np.uint64(32)) % np.uint64(MEAN) == 0) | last)
        known, todo, close, tries = np.full(len(h), NOWHERE), np.r_[0, may + 1][: len(may)], np.flatnonzero(last), 0
        while len(todo):  # lines after ends by hash, then those after ends by number, soon all that are left
            known[todo] = at = self._after(todo, may, close, min_bytes)
            after = at[at >= 0] + 1
            after, tries = after[after < len(h)], tries + 1
            todo = np.unique(after[known[after] == NOWHERE])
            if len(todo) and tries == 4:
                todo = np.flatnonzero(known == NOWHERE)
        begins = np.r_[True, last[:-1]].tolist() if len(h) else []
        first, out, ends, known = 0, [], [], known.tolist()
        while first < len(known):
            end = known[first]
            if end >= 0 or begins[first]:
                out.append(first)
                ends.append(end if end >= 0 else -1 - end)
            else:  # what is left of a text goes with the chunk before
                ends[-1] = -1 - end
            first = ends[-1] + 1
        return np.array([out, [e + 1 for e in ends]], np.int64).T.reshape(-1, 2)

    def _after(self, first: np.ndarray, may: np.ndarray, close: np.ndarray, min_bytes: int) -> np.ndarray:
        """The last line of the chunk that begins at each line of ``first``; -1 minus the text's last line, where too little is left.

        may, close: lines that end a chunk by their hash, and texts.
        """
        large = np.searchsorted(self.stop, self.start[first] + min_bytes)
        low = np.maximum(first + MIN_LINES - 1, large)
        end = close[np.searchsorted(close, first)]
        chosen = may[np.minimum(np.searchsorted(may, low), len(may) - 1)]
        return np.where(low > end, -1 - end, np.minimum(chosen, np.maximum(first + MAX_LINES - 1, large)))


def chunks(text: bytes, min_bytes: int = MIN_BYTES) -> list[tuple[int, int]]:
    """First byte, and byte after the last, of each chunk of a text.

    A chunk has MIN_LINES and ``min_bytes`` at least, if the text has so many. It ends after the first line from there on whose
    hash, rolled over the line before, is divisible by MEAN, or that is its MAX_LINES-th; what is left at the end of a
    text goes with its last chunk.
    """
    lines = Lines.of([text])
    return [(int(lines.start[a] - lines.begin[0]), int(lines.stop[b - 1] - lines.begin[0])) for a, b in lines.chunks(min_bytes)]


def without(text: bytes, gone: list[tuple[int, int]]) -> bytes:
    """Text without some ranges of bytes, in order, each of whole lines.

    The blank or line break after a range goes as well. A line break stays where something of its own line is kept; then,
    and at the end of the text, the blank or break before the range goes instead.
    """
    joined: list[list[int]] = []
    for lo, hi in gone:
        if joined and lo == joined[-1][1] + 1:
            joined[-1][1] = hi
        else:
            joined.append([lo, hi])
    out, at = [], 0
    for lo, hi in joined:
        before = hi == len(text) or (text[hi : hi + 1] == b"\n" and lo > 0 and text[lo - 1 : lo] != b"\n")
        out.append(text[at : max(0, lo - before)])
        at = hi + (not before)
    return b"".join([*out, text[at:]])


def _flat(marks: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row of each mark in a column of arrays of structs, and the marks' fields."""
    rows = np.repeat(np.arange(len(marks)), marks.value_lengths().fill_null(0).to_numpy())
    flat = marks.flatten()
    return rows, {f.name: flat.field(f.name).to_numpy(zero_copy_only=False) for f in flat.type}


def occurrences(docs: DataFrame, tid: Column | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """A row for each chunk that may be removed: its document, its bytes, its number of lines, and a 64-bit digest of its bytes."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines = Lines.of([t or b"" for t in batch.column(2).to_pylist()])
        found = lines.chunks(min_bytes)
        lo, hi, n = lines.start[found[:, 0]], lines.stop[found[:, 1] - 1], found[:, 1] - found[:, 0]
        large = (n >= MIN_LINES) & (hi - lo >= min_bytes)
        doc, lo, hi, n = lines.text[found[large, 0]], lo[large], hi[large], n[large]
        parts = [lines.buffer[x:y] for x, y in zip(lo.tolist(), hi.tolist(), strict=True)]
        some = np.array([not p.isspace() for p in parts], bool)
        h = np.array([xxhash.xxh3_64_intdigest(p) for p in parts], np.uint64).astype(np.int64)[some]
        take = pa.array(doc[some])
        places = [x[some].astype(np.int32) for x in (lo - lines.begin[doc], hi - lines.begin[doc], n)]
        return pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), *map(pa.array, places), pa.array(h)], ["doc_id", "tid", "lo", "hi", "lines", "h"])

    return keyed(docs, tid).mapInArrow(by_slice(work, ROWS, SIZE), f"doc_id {kind}, tid bigint, lo int, hi int, lines int, h bigint")


def _contents(marked: DataFrame) -> DataFrame:
    """Digest and bytes of every chunk that ``marked`` lists in __chunks."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, (rows, m) = batch.column(0).to_pylist(), _flat(batch.column(1))
        data = [texts[r][lo:hi] for r, lo, hi in zip(rows.tolist(), m["lo"].tolist(), m["hi"].tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(m["h"]), pa.array(data, pa.binary())], ["h", "data"])

    rows = marked.filter("__chunks is not null").select(F.col("text").cast("binary").alias("text"), "__chunks")
    return rows.mapInArrow(by_slice(work, ROWS, SIZE), "h bigint, data binary")


def _marked(docs: DataFrame, marks: DataFrame, tid: Column) -> DataFrame:
    """docs with __chunks, the array of a document's repeated chunks, null where it has none; a written table."""
    of = marks.select(F.col("doc_id").alias("__doc_id"), F.col("tid").alias("__of"), "__chunks")
    rows = docs.withColumn("__tid", tid)
    joined = rows.join(of, rows["doc_id"].eqNullSafe(of["__doc_id"]) & (rows["__tid"] == of["__of"]), "left")
    return stash(joined.drop("__doc_id", "__of", "__tid"), "marked")


def repeats(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """docs, all columns, with __chunks: the repeated chunks of each text, and whether their first occurrence is in it.

    First is the occurrence with the smallest doc_id (nulls last), text hash and place. Chunks are counted by a 64-bit
    digest; then the bytes of those met again are compared, by their smallest and largest value for a digest, and a
    digest that stands for different bytes is struck out. Counts and comparisons are summed in each task before they
    shuffle, and occurrences are joined to their first, so no group is gathered. Texts are shuffled once, when the
    tables of chunks have gone.
    """
    repeat = ids_repeat(docs)
    tid = tid_of(docs, repeat)
    found = stash(occurrences(docs, tid, min_bytes), "chunks")
    # the document is enough, and the minimum of a number needs no sort; within it the first is told from the last step's arrays
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tid") if repeat else F.col("doc_id")
    again = stash(found.groupBy("h").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1"), "again")
    repeated = join_counted(found, again, ["h"], "n").withColumn("is_first", place.eqNullSafe(F.col("first")))
    gathered = F.array_sort(F.collect_set(F.struct("lo", "hi", "lines", "h", "is_first"))).alias("__chunks")
    marks = stash(repeated.groupBy("doc_id", "tid").agg(gathered), "marks")
    for table in (found, again):
        forget(table)
    marked = _marked(docs, marks, tid)
    differ = stash(_contents(marked).groupBy("h").agg(F.min("data").alias("a"), F.max("data").alias("b")).filter("a <> b").select("h"), "differ")
    if not differ.isEmpty():
        same = marks.select("doc_id", "tid", F.inline("__chunks")).join(differ, "h", "left_anti").groupBy("doc_id", "tid").agg(gathered)
        before, marked = marked, _marked(docs, same, tid)
        forget(before)
    for table in (marks, differ):
        forget(table)
    return marked


def _apply(marked: DataFrame, columns: list[str], count: bool = False) -> DataFrame:
    """``columns`` of marked with the text cut, and __lines (0 unless asked to ``count``) and __removed, counts of lines."""
    schema = marked.select(*columns).schema.add("__lines", "long").add("__removed", "long")
    at = columns.index("text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        n = np.bincount(Lines.of([(t or "").encode() for t in texts]).text, minlength=len(texts)).astype(np.int64) if count else np.zeros(len(texts), np.int64)
        rows, m = _flat(batch.column(len(columns)))
        gone = np.ones(len(rows), bool)
        own = np.flatnonzero(m["is_first"].astype(bool))
        own = own[np.lexsort((m["lo"][own], m["h"][own], rows[own]))]
        again = (rows[own][1:] == rows[own][:-1]) & (m["h"][own][1:] == m["h"][own][:-1])
        gone[own[np.r_[True, ~again][: len(own)]]] = False
        rows, lo, hi = rows[gone], m["lo"][gone].tolist(), m["hi"][gone].tolist()
        removed = np.bincount(rows, m["lines"][gone], len(texts)).astype(np.int64)
        ends = np.searchsorted(rows, np.arange(len(texts) + 1))
        for i in np.flatnonzero(removed).tolist():
            texts[i] = without(texts[i].encode(), list(zip(lo[ends[i] : ends[i + 1]], hi[ends[i] : ends[i + 1]], strict=True))).decode()
        cols = list(batch.columns[: len(columns)])
        cols[at] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays([*cols, pa.array(n), pa.array(removed)], [*columns, "__lines", "__removed"])

    return marked.select(*columns, "__chunks").mapInArrow(by_slice(work, ROWS, SIZE), schema)


def dedup(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """docs with repeated chunks of lines removed but for their first occurrence. All columns are kept, in order.

    Lines end at ``\n`` and at blanks that the bytes before choose; a chunk has several, and ``min_bytes`` at least: shorter
    repeats stay, however often they occur, as does a text of one line. Where a passage differs in a word, the chunk with
    that word stays. n_chars, if there, is counted anew where a text changed. A document of which nothing is left is removed; one that
    was null or empty before stays. Rows that repeat both id and text are one document and are cut alike. An empty
    table gives an empty result.
    """
    names = docs.columns
    out = _apply(repeats(docs, min_bytes), names).filter((F.col("__removed") == 0) | (F.trim("text") != ""))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("__removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*names)


def report(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """doc_id, n_lines, n_removed and kept_sha256 (of the text that is left) for every row of docs; null texts count as empty."""
    done = _apply(repeats(docs.select("doc_id", "text"), min_bytes), ["doc_id", "text"], count=True)
    text = F.coalesce("text", F.lit("")).cast("binary")
    return done.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"), F.sha2(text, 256).alias("kept_sha256"))
