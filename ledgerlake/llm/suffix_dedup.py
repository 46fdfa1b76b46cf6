"""Suffix-array deduplication of bytes by bucket-pointer refinement.

The corpus is split among tasks by anchors of 64 bytes (see :mod:`passages`); the suffixes of what one anchor's windows
hold are then sorted up to 400 bytes within a task. Suffixes are put in buckets by their first q = 8 bytes, and each has a pointer, the
place of its bucket in sorted order. A round refines all buckets of two or more: their suffixes are sorted by the
pointers of the suffixes some bytes further on, and the new pointers are what the next round, at twice the depth,
reads. Suffixes alone in their bucket are done. Only bytes are compared, no hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.anchors import mix
from ledgerlake.llm.common import by_slice
from ledgerlake.llm.passages import Buckets, Kind, Laid, covered, with_ranges

WINDOW, GRAM, GROUP = 400, 64, 8000
#: Bytes of the grams that make the initial buckets.
Q = 8


def _grams(data: np.ndarray) -> np.ndarray:
    """The Q bytes from each place as one number; Q - 1 fewer than bytes."""
    x = data.astype(np.uint64)
    for h in (1, 2, 4):
        x = x[:-h] | x[h:] << np.uint64(8 * h)
    return x


def refine(contents: list[bytes], window: int) -> Buckets:
    """Buckets of two or more of the places from which ``window`` equal bytes follow within a content."""
    data = np.frombuffer(b"".join(contents), np.uint8)
    size = np.array([len(c) for c in contents], np.int64)
    ends = np.cumsum(size)
    row = np.repeat(np.arange(len(contents)), size)
    room = ends[row] - np.arange(len(data))
    at = np.flatnonzero(room >= Q)
    key = _grams(data)[at] if len(at) else np.zeros(0, np.uint64)
    pointer, depth, old = np.zeros(len(data), np.int64), Q, np.zeros(len(at), np.int64)
    while True:
        order = np.argsort(key)
        at, key, old = at[order], key[order], old[order]
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(at) else np.zeros(0, np.int64)
        members = np.diff(np.r_[new, len(at)])
        begin = np.searchsorted(old, old[new])  # where the bucket that was refined begins
        pointer[at] = np.repeat(old[new] + new - begin, members)
        at = at[np.repeat(members > 1, members)]
        if depth >= window:
            return row[at], at - (ends - size)[row[at]], pointer[at]
        step = min(depth, window - depth)
        depth += step
        at = at[room[at] >= depth]
        old = pointer[at]
        key = old << 32 | pointer[at + step]


def lay(texts: list[bytes]) -> Laid:
    """Identifiers of all GRAM-byte grams of texts laid end to end, for anchors."""
    buf = b"".join(texts)
    x = _grams(np.frombuffer(buf, np.uint8))
    for h in (8, 16, 32):
        x = mix(x[:-h], x[h:])
    places = np.arange(len(buf) + 1)
    return x, np.cumsum([len(t) for t in texts], dtype=np.int64), buf, places[:-1], places[1:]


def cut(text: bytes, places: list[tuple[int, int]]) -> list[bytes]:
    return [text[lo : lo + n] for lo, n in places]


def kind(window: int = WINDOW, group: int = GROUP) -> Kind:
    return Kind(lay, cut, refine, GRAM, window, spare_first=False, group=group)


def dedup(docs: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Whole texts without the bytes that a repeated string of ``window`` bytes covers.

    docs: doc_id (an integer), text; further columns are ignored. Texts are taken as UTF-8 bytes; a string is repeated
    if it starts anywhere else as well, in the same text too, and all its occurrences go. Returns for each row doc_id,
    kept (binary), n_bytes, n_removed and n_spans (maximal removed stretches). A null text counts as empty. Rows that
    repeat a text are copies of each other, also under one doc_id. An empty table gives an empty result. window is at
    least 2 * GRAM.
    """
    rows = with_ranges(docs, kind(window, group))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            spans = covered(ranges, window, len(text))
            kept = b"".join([text[a:b] for a, b in zip([0, *[x[1] for x in spans]], [*[x[0] for x in spans], len(text)], strict=True)])
            out.append((kept, len(text), len(text) - len(kept), len(spans)))
        kept, *counts = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), *[pa.array(c, pa.int64()) for c in counts]], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return rows.mapInArrow(by_slice(work), "doc_id bigint, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint")
