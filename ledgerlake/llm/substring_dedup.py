"""Substring deduplication of words by prefix-partitioned suffix trees.

Suffixes are split by prefixes of variable length into groups that fit a task: by an anchor of four words and, where it
has several continuations, by the run of windows around it (see :mod:`passages`); a group that is still too large is
split by the whole 20-word prefix. A task builds the lower part of the suffix tree of its group: suffixes that share
their first eight words with another are sorted, and the number of words that neighbours share gives the internal
nodes. Those at least 20 words deep are the repeats; of the suffixes below one, all but the earliest go. Words are
compared as such, not their hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from ledgerlake.llm.anchors import mix
from ledgerlake.llm.common import by_slice
from ledgerlake.llm.passages import Buckets, Kind, Laid, covered, with_ranges

WINDOW, GRAM, GROUP = 20, 4, 50_000
#: Words of the prefixes by which a task splits its suffixes.
PREFIX = 8
#: Words whose identifier a worker remembers; when full it starts anew.
CACHE = 500_000


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = got = xxhash.xxh3_64_intdigest(word)
        return got


_ids = _Ids()


def lay(texts: list[bytes]) -> Laid:
    """Identifiers of all GRAM-word grams of texts laid end to end, for anchors."""
    split = [t.split() for t in texts]
    words = [w for s in split for w in s]
    x = np.fromiter(map(_ids.__getitem__, words), np.uint64, len(words))
    for h in (1, 2):
        x = mix(x[:-h], x[h:])
    size = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(size + 1) - 1
    return x, np.cumsum([len(s) for s in split], dtype=np.int64), b" ".join(words), stops - size, stops


def cut(text: bytes, places: list[tuple[int, int]]) -> list[bytes]:
    words = text.split()
    return [b" ".join(words[lo : lo + n]) for lo, n in places]


class _Numbers(dict):
    """Numbers words from 1, in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = got = len(self) + 1
        return got


def subtree(contents: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The suffix tree of word sequences from ``least`` words (PREFIX or more) down.

    Returns row and place of the suffixes below its highest internal nodes at that depth, in the tree's order, and for
    each node where its suffixes begin in that order and its depth, the words that all of them share.
    """
    split, number = [c.split() for c in contents], _Numbers()
    size = np.array([len(ws) for ws in split], np.int64)
    n = int(size.sum())
    word = np.fromiter((number[w] for ws in split for w in ws), np.int64, n)
    row, ends = np.repeat(np.arange(len(split)), size), np.cumsum(size)
    room = ends[row] - np.arange(n)
    at = lambda x, i, k: np.where(room[i] > k, x[np.minimum(i + k, n - 1)], 0)  # noqa: E731, x at k words on; 0 past the end
    prefix, every, step = word, np.arange(n), 1
    while step < PREFIX:  # numbers of the prefixes of 2, 4 and 8 words, in word order
        prefix = np.unique(prefix << 32 | at(prefix, every, step), return_inverse=True)[1] + 1
        step *= 2
    suffix = np.flatnonzero(room >= least)
    suffix = suffix[np.bincount(prefix[suffix], minlength=1)[prefix[suffix]] > 1]
    parts = np.array([at(prefix, suffix, k) for k in range(0, max(least, int(size.max(initial=0))), PREFIX)])
    order = np.lexsort(parts[::-1])
    suffix, parts = suffix[order], parts[:, order]
    if not len(suffix):
        return row[suffix], suffix, suffix, suffix
    differ = np.concatenate([parts[:, 1:] != parts[:, :-1], np.ones((1, len(suffix) - 1), bool)])
    shared = PREFIX * differ.argmax(axis=0)
    for _ in range(PREFIX - 1):  # words that neighbours share beyond their equal parts
        on, below = shared < np.minimum(room[suffix[1:]], room[suffix[:-1]]), np.minimum
        shared = shared + (on & (word[below(suffix[1:] + shared, n - 1)] == word[below(suffix[:-1] + shared, n - 1)]))
    shared = np.minimum(shared, np.minimum(room[suffix[1:]], room[suffix[:-1]]))
    begin = np.flatnonzero(np.r_[True, shared < least])
    members = np.diff(np.r_[begin, len(suffix)])
    depth = np.minimum.reduceat(np.r_[room[suffix[:1]], np.where(shared < least, room[suffix[1:]], shared)], begin)
    keep, members, depth = np.repeat(members > 1, members), members[members > 1], depth[members > 1]
    suffix = suffix[keep]
    return row[suffix], suffix - (ends - size)[row[suffix]], np.cumsum(members) - members, depth


def repeats(contents: list[bytes], window: int) -> Buckets:
    """The suffixes below each internal node at least ``window`` words deep."""
    row, place, begin, _ = subtree(contents, window)
    return row, place, np.repeat(np.arange(len(begin)), np.diff(np.r_[begin, len(row)]))


def kind(window: int = WINDOW, group: int = GROUP) -> Kind:
    return Kind(lay, cut, repeats, GRAM, window, spare_first=True, group=group)


def dedup(docs: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """Whole texts without the words that a window of ``window`` words met earlier covers.

    docs: doc_id (an integer), text; further columns are ignored. Words are what white space (space, \\t to \\r)
    separates. Earlier is a smaller doc_id, nulls last, or an earlier place in the same text; rows that repeat both id
    and text are one document and are cut alike. Returns for each row doc_id, kept (words joined by a space), n_words
    and n_removed. A null text has no words. An empty table gives an empty result. window is at least 2 * GRAM.
    """
    rows = with_ranges(docs, kind(window, group))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            words = text.split()
            n = len(words)
            for a, b in reversed(covered(ranges, window, n)):
                del words[a:b]
            out.append((b" ".join(words).decode(), n, n - len(words)))
        kept, *counts = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.string()), *[pa.array(c, pa.int64()) for c in counts]], ["doc_id", "kept", "n_words", "n_removed"])

    return rows.mapInArrow(by_slice(work), "doc_id bigint, kept string, n_words bigint, n_removed bigint")
