"""Runs of repeated words (maximal repetitions), found in a grammar that Re-Pair makes of the word ids.

1. Stretches in which every 8 words occur again in their document; a run of the lengths sought lies within one.
2. Re-Pair in rounds: each round replaces every repeated pair wherever no more frequent pair overlaps it, until no pair
   repeats. What a round replaces are all places of a nonterminal in the text.
3. For each nonterminal, once, the runs that cross the boundary between its halves, and so for the boundaries of a
   balanced tree over what the rounds leave. Each run of the text lies whole in the lowest node that holds it.
4. Translated to all places of their nonterminal, intervals of equal period that share a period are merged.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.common import by_slice, keyed

#: A run has so many words, and so many periods, at least.
WORDS, PERIODS = 24, 3
#: Words that occur again wherever a run is: with at least WORDS words and PERIODS periods every GRAM of them recur.
GRAM = 8
#: Comparisons of single candidates for each word of a node, after which all periods are compared in linear time.
PATIENCE = 8
#: An odd number whose multiples order pairs of equal frequency at random.
MIX = np.uint64(0x9E3779B97F4A7C15)
Run = tuple[int, int, int]


def stretches(ids: np.ndarray, of: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of words, none across documents, in which each GRAM words occur twice or more in their document.

    ids and of: word and document of each place. Grams are told apart by a hash; equal ones always agree, so no run is missed.
    """
    n = len(ids) - GRAM + 1
    if n <= 0:
        return []
    h = (ids.astype(np.uint64) + np.uint64(1)) * MIX
    h ^= h >> np.uint64(32)
    step = 1
    while step < GRAM:
        h = h[:-step] * np.uint64(0xD6E8FEB86659FD93) + h[step:]
        h ^= h >> np.uint64(29)
        step *= 2
    inside = of[:n] == of[GRAM - 1 :]
    h = (h + of[:n].astype(np.uint64)) * MIX
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    again = np.zeros(n, bool)
    again[order[1:]] = same
    again[order[:-1]] |= same
    edge = np.flatnonzero(np.diff(np.r_[False, again & inside, False].astype(np.int8)))
    # a stretch cannot reach over the end of a document: the grams that would are not inside
    return [(a, b + GRAM - 1) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True) if b - a >= WORDS - GRAM + 1]


def repair(ids: np.ndarray, ends: np.ndarray) -> tuple[list[tuple[int, int, int, np.ndarray]], np.ndarray]:
    """The grammar of some texts laid end to end, of which none shares a symbol with another.

    Returns the nonterminals, each with the lengths of its halves in words and all its places, and the places of the symbols that are left.
    """
    symbols, at = np.unique(ids, return_inverse=True)[1].astype(np.int64), np.arange(len(ids))
    text = np.searchsorted(ends, at, side="right")
    size = np.ones(len(ids), np.int64)
    new, rules = int(symbols.max(initial=0)) + 1, []
    while len(symbols) > 1:
        a, b = symbols[:-1], symbols[1:]
        fits = text[:-1] == text[1:]
        # of three and more equal symbols in a row every other pair is one
        equal = (a == b) & fits
        places = np.arange(len(a))
        row = places - np.maximum.accumulate(np.where(equal, -1, places + 1)).clip(0) if equal.any() else np.zeros(len(a), int)
        fits &= ~equal | (row % 2 == 0)
        where = np.flatnonzero(fits)
        _, pair, count = np.unique(a[where] * new + b[where], return_inverse=True, return_counts=True)
        mixed = np.arange(len(count)).astype(np.uint64) * MIX >> np.uint64(32)
        rank = np.empty(len(count), np.int64)
        rank[np.lexsort((mixed, count))] = np.arange(1, len(count) + 1)
        weight = np.zeros(len(a) + 2, np.int64)
        weight[where + 1] = np.where(count[pair] > 1, rank[pair], 0)
        mine = weight[1:-1]
        chosen = (mine > 0) & (mine > weight[:-2]) & (mine > weight[2:])
        got = np.zeros(len(a), np.int64)
        got[where] = pair
        times = np.bincount(got[chosen], minlength=len(count))
        chosen &= times[got] > 1
        first = np.flatnonzero(chosen)
        if not len(first):
            break
        order = first[np.argsort(got[first], kind="stable")]
        cut = np.flatnonzero(np.diff(got[order], prepend=-1))
        name = np.zeros(len(count), np.int64)
        name[got[order[cut]]] = new + np.arange(len(cut))
        halves = size[order[cut]], size[order[cut] + 1]
        rules += [(x, y, places) for x, y, places in zip(halves[0].tolist(), halves[1].tolist(), np.split(at[order], cut[1:]), strict=True) if x + y >= WORDS]
        symbols = symbols.copy()
        symbols[first] = name[got[first]]
        size = size.copy()
        size[first] += size[first + 1]
        left = np.ones(len(symbols), bool)
        left[first + 1] = False
        symbols, size, at, text = symbols[left], size[left], at[left], text[left]
        new += len(cut)
    return rules, at


def _forward(w: list[int], i: int, j: int, most: int) -> int:
    """How many words from i on equal those from j on, ``most`` at most."""
    done, step = 0, 8
    while done < most:
        step = min(step, most - done)
        if w[i + done : i + done + step] == w[j + done : j + done + step]:
            done, step = done + step, 2 * step
        elif step == 1:
            return done
        else:
            step //= 2
            most = min(most, done + 2 * step + 1)
    return done


def _backward(w: list[int], i: int, j: int, most: int) -> int:
    """How many words up to i, backwards, equal those up to j, ``most`` at most."""
    done, step = 0, 8
    while done < most:
        step = min(step, most - done)
        if w[i - done - step + 1 : i - done + 1] == w[j - done - step + 1 : j - done + 1]:
            done, step = done + step, 2 * step
        elif step == 1:
            return done
        else:
            step //= 2
            most = min(most, done + 2 * step + 1)
    return done


def _prefixes(w: list[int]) -> list[int]:
    """For each place, how many words from there on equal the words from the beginning on."""
    z, left, right = [len(w)] + [0] * (len(w) - 1), 0, 0
    for i in range(1, len(w)):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < len(w) and w[k] == w[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _enough(equal: int, q: int) -> bool:
    return equal + q >= max(WORDS, PERIODS * q)


def _linear(w: list[int], lo: int, b: int, hi: int) -> list[Run]:
    """:func:`crossing` in time in proportion to hi - lo, whatever the words."""
    whole, out = w[lo:hi], []
    y = b - lo
    z = whole[y:]
    ahead, back = _prefixes(z), _prefixes([*whole[:y][::-1], -1, *whole[::-1]])
    n = len(whole)
    for q in range(1, min(len(z), n // PERIODS) + 1):  # w[b-1] and w[b-1+q]
        ls = min(back[y + 1 + n - (y + q)], y)
        rs = ahead[q] if q < len(z) else 0
        if ls and _enough(ls + rs, q):
            out.append((b - ls, b + rs + q, q))
    left = whole[:y][::-1]
    ahead, back = _prefixes(left), _prefixes([*z, -1, *whole])
    for q in range(1, min(y, n // PERIODS) + 1):  # w[b] and w[b-q]
        rs = min(back[len(z) + 1 + y - q], len(z))
        ls = ahead[q] if q < y else 0
        if rs and _enough(ls + rs, q):
            out.append((b - ls - q, b + rs, q))
    return _primitive(out)


def _primitive(found: list[Run]) -> list[Run]:
    """Of the periods of one interval only the smallest, of which the others are multiples."""
    out: dict[tuple[int, int], int] = {}
    for s, e, q in sorted(found, key=lambda r: r[2]):
        out.setdefault((s, e), q)
    return [(s, e, q) for (s, e), q in out.items()]


def crossing(w: list[int], lo: int, b: int, hi: int) -> list[Run]:
    """Runs within w[lo:hi] that hold the words at b - 1 and at b, as start, end and period.

    A run that reaches a period past b has w[b-1] == w[b-1+q]; any other has w[b] == w[b-q].
    """
    longest, out = (hi - lo) // PERIODS, []
    if hi - lo < WORDS:
        return out
    work, bound, done = 0, PATIENCE * (hi - lo), []
    word, j, stop = w[b - 1], b - 1, min(hi, b + longest)
    while True:
        try:
            j = w.index(word, j + 1, stop)
        except ValueError:
            break
        q = j - b + 1
        if any(q % d == 0 and j < end for d, end in done):
            continue  # a multiple of a run's period, within it
        rs = _forward(w, b, b + q, hi - b - q)
        ls = 1 + _backward(w, b - 2, b - 2 + q, b - 1 - lo)
        if _enough(ls + rs, q):
            out.append((b - ls, b + rs + q, q))
            done.append((q, b + rs + q))
        work += ls + rs + 2 + len(done)
        if work > bound:
            return _linear(w, lo, b, hi)
    word, done = w[b], []
    back = max(lo, b - longest)
    for j in reversed(_places(w, word, back, b)):
        q = b - j
        if any(q % d == 0 and j >= start for d, start in done):
            continue
        rs = 1 + _forward(w, b + 1, b + 1 - q, hi - b - 1)
        ls = _backward(w, b - 1, b - 1 - q, b - q - lo)
        if _enough(ls + rs, q):
            out.append((b - ls - q, b + rs, q))
            done.append((q, b - ls - q))
        work += ls + rs + 2 + len(done)
        if work > bound:
            return _linear(w, lo, b, hi)
    return _primitive(out)


def _places(w: list[int], word: int, start: int, stop: int) -> list[int]:
    out = []
    try:
        while True:
            start = w.index(word, start, stop)
            out.append(start)
            start += 1
    except ValueError:
        return out


def merged(found: dict[int, list[tuple[int, int]]]) -> list[Run]:
    """The maximal intervals of each period, in order."""
    all_: list[Run] = []
    for q in sorted(found):
        out: list[list[int]] = []
        for s, e in sorted(found[q]):
            if out and s + q <= out[-1][1]:  # they share a period
                out[-1][1] = max(out[-1][1], e)
            else:
                out.append([s, e])
        all_ += [(s, e, q) for s, e in out]
    return sorted(all_)


def runs(ids: np.ndarray, of: np.ndarray) -> list[Run]:
    """Start, end and smallest period of every run in some texts laid end to end; ``of`` rises, and tells the text of each place."""
    parts = stretches(ids, of)
    if not parts:
        return []
    size = np.array([b - a for a, b in parts])
    begin, ends = np.array([a for a, _ in parts]), np.cumsum(size)
    shift = begin - (ends - size)
    inner = np.concatenate([ids[a:b] for a, b in parts])
    own = np.repeat(np.arange(len(parts)), size)  # symbols of different stretches never agree
    inner = np.unique(own * (int(ids.max()) + 1) + inner, return_inverse=True)[1]
    w = inner.tolist()
    rules, left = repair(inner, ends)
    found: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for x, y, places in rules:
        at = int(places[0])
        for s, e, q in crossing(w, at, at + x, at + x + y):
            found[q] += zip((places + (s - at)).tolist(), (places + (e - at)).tolist(), strict=True)
    left = np.append(left, len(w))
    bounds = np.searchsorted(left, np.r_[0, ends])
    nodes = [(int(a), int(b)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    at = left.tolist()
    while nodes:  # the tree over a stretch's symbols, halved by words
        a, b = nodes.pop()
        if b - a < 2 or at[b] - at[a] < WORDS:
            continue
        m = min(b - 1, max(a + 1, int(np.searchsorted(left[a : b + 1], (at[a] + at[b]) // 2)) + a))
        for s, e, q in crossing(w, at[a], at[m], at[b]):
            found[q].append((s, e))
        nodes += [(a, m), (m, b)]
    move = np.repeat(shift, size)
    return sorted((s + int(move[s]), e + int(move[s]), q) for s, e, q in merged(found))


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words that are searched: those of one text in ten are made periodic from a place on; a null id is left alone."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


SCHEMA = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def detect(docs: DataFrame, plant: bool = False, texts: bool = True) -> DataFrame:
    """One row for each of docs: doc_id, runs (array of start, length, period), collapsed (text) and their digests.

    Without ``texts`` the columns runs and collapsed are left out.

    Words are stretches without ASCII white space, of whole texts; null and empty texts have none. A run is a stretch of
    words with a smallest period q, max(24, 3 q) long or longer, that cannot be extended; ``collapsed`` keeps the first q
    words of each and drops the rest, joined by spaces. start, length, period, exponent_milli: the run with the greatest
    length / period, ties to the smallest start, then period; null if there is none. Rows are judged each by itself, repeated
    ones alike; further columns are ignored. ``plant`` makes one text in ten periodic first, by crc32 of doc_id.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        number: dict[bytes, int] = {}
        split = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = (text or b"").split()
            split.append(planted(doc, words) if plant else words)
        size = np.array([len(x) for x in split], np.int64)
        ids = np.fromiter((number.setdefault(x, len(number)) for words in split for x in words), np.int64, int(size.sum()))
        of, begin = np.repeat(np.arange(len(split)), size), np.cumsum(size) - size
        by: dict[int, list[Run]] = defaultdict(list)
        for s, e, q in runs(ids, of):
            doc = int(of[s])
            by[doc].append((s - int(begin[doc]), e - s, q))
        rows = [_row(words, by.get(i, [])) for i, words in enumerate(split)]
        cols = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types) if k >= first]
        return pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc_id", *names[first:]])

    first = 0 if texts else 2
    whole = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string, "
    names = ["runs", "collapsed", *(x.split()[0] for x in SCHEMA.split(", "))]
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    types = [pa.list_(run), pa.string(), *[pa.int64()] * 5, pa.string(), pa.string()]
    return keyed(docs).select("doc_id", "text").mapInArrow(by_slice(work), f"doc_id {kind}, {whole if texts else ''}{SCHEMA}")


def _row(words: list[bytes], found: list[Run]) -> tuple:
    kept = words
    best = (None, None, None, None)
    if found:
        drop = np.zeros(len(words) + 1, np.int64)
        for s, n, q in found:
            drop[s + q] += 1
            drop[s + n] -= 1
        keep = np.cumsum(drop)[:-1] == 0
        kept = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
        s, n, q = found[0]
        for a, m, p in found[1:]:  # in order of start, so that an equal one later does not win
            if m * q > n * p:
                s, n, q = a, m, p
        best = (s, n, q, 1000 * n // q)
    told = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    left = b" ".join(kept)
    return [{"start": s, "length": n, "period": q} for s, n, q in found], left.decode(errors="replace"), len(found), *best, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(left).hexdigest()
