"""Brute-force versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import xxhash

BLANK_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def ascii_lower(b: bytes) -> bytes:
    return re.sub(rb"[A-Z]", lambda m: m[0].lower(), b)


def contamination(text: bytes, items: list[tuple[str, bytes]], window: int = 10) -> tuple[int, set[int], set[str]]:
    words, hit, names = BENCH_WORD.findall(ascii_lower(text)), set(), set()
    for name, item in items:
        ws = BENCH_WORD.findall(ascii_lower(item))
        n = min(window, len(ws))
        grams = {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                names.add(name)
    return len(words), hit, names


def without_words(text: bytes, hit: set[int]) -> bytes:
    """Text without its hit words; one space where they stood, none at the edges."""
    places = [m.span() for m in BENCH_WORD.finditer(ascii_lower(text))]
    parts, at = [], 0
    for i in sorted(hit):
        if i - 1 not in hit:
            parts.append(text[at : places[i][0]].rstrip())
        at = places[i][1]
    return b" ".join(x for x in [*parts, text[at:].lstrip() if hit else text[at:]] if x)


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = list(zip(words, words[1:], words[2:], strict=False))
    count = Counter(grams)
    at = {i + k for i, g in enumerate(grams) if count[g] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(at)


def repeated_bytes(texts: list[bytes], window: int) -> list[list[bool]]:
    count = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        mark = [False] * len(t)
        for i in range(len(t) - window + 1):
            if count[t[i : i + window]] > 1:
                mark[i : i + window] = [True] * window
        out.append(mark)
    return out


def later_words(texts: list[bytes], window: int) -> list[tuple[list[bytes], list[bool]]]:
    """Texts in order of doc_id; words and which of them go."""
    seen, out = set(), []
    for t in texts:
        ws = BLANK_WORD.findall(t)
        mark = [False] * len(ws)
        for i in range(len(ws) - window + 1):
            g = tuple(ws[i : i + window])
            if g in seen:
                mark[i : i + window] = [True] * window
            seen.add(g)
        out.append((ws, mark))
    return out


def fingerprint(text: bytes) -> int:
    ws = BLANK_WORD.findall(ascii_lower(text))
    if not ws:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(ws[i : i + 3]), 42) for i in range(max(1, len(ws) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows: list[tuple[int, int]], bits: int = 3) -> list[int]:
    """Component of each (doc_id, fingerprint), by its smallest doc_id."""
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= bits:
                parent[find(i)] = find(j)
    low = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        low[find(i)].append(d)
    return [min(low[find(i)]) for i in range(len(rows))]


def lines_of(text: bytes, cut: int = 1) -> list[tuple[int, int]]:
    """Where each line of a text begins and ends; a line ends at a line break, or at a blank that the three bytes before it choose."""
    out, begin = [], 0
    for i, byte in enumerate(text):
        a, b, c = (text[i - k] if i >= k else 10 for k in (1, 2, 3))
        h = (2654435761 * a + 40503 * b + 9973 * c) % 2**32
        h = (h ^ h >> 15) * 0x85EBCA6B % 2**32
        h ^= h >> 13
        if byte == 10 or (byte in (32, 9) and h % cut == 0):
            out.append((begin, i))
            begin = i + 1
    return [*out, (begin, len(text))]


def line_chunks(text: bytes, size: int, least: int = 3, most: int = 16) -> list[list[tuple[int, int]]]:
    """The lines of each chunk: several, of ``size`` bytes together, up to one that the hashes of it and the line before choose."""
    lines, out, held, before = lines_of(text), [], [], 0
    for a, b in lines:
        h = sum((x + 1) * pow(0xD6E8FEB86659FD93, k, 2**64) for k, x in enumerate(text[a:b])) % 2**64
        roll = (3 * h + 0x9E3779B97F4A7C15 * before) % 2**64
        roll = (roll ^ roll >> 29) * 0x9E3779B97F4A7C15 % 2**64
        before = h
        held.append((a, b))
        if ((roll >> 32) % 3 == 0 or len(held) >= most) and len(held) >= least and b - held[0][0] >= size:
            out.append(held)
            held = []
    if held and out and (len(held) < least or held[-1][1] - held[0][0] < size):
        out[-1] += held
    elif held:
        out.append(held)
    return out


def cut_lines(rows: list[tuple[int, bytes]], size: int, least: int = 3) -> dict[int, list[list[tuple[int, int]]]]:
    """The chunks to cut from each text, rows in order of doc_id: those that were met before."""
    seen, cut = set(), defaultdict(list)
    for d, t in rows:
        for lines in line_chunks(t, size):
            part = t[lines[0][0] : lines[-1][1]]
            if len(lines) >= least and len(part) >= size and part.strip(b" \t\n\r\x0b\x0c"):
                if part in seen:
                    cut[d].append(lines)
                seen.add(part)
    return cut


def without_lines(text: bytes, cut: list[list[tuple[int, int]]]) -> tuple[bytes, int, int]:
    """Text without some chunks, its number of lines before, and how many went.

    What ends a removed line goes with it, but a line break stays where something of its own line is kept; what ended the
    last line before goes instead, as it does at the end of the text.
    """
    lines, gone = lines_of(text), {x for c in cut for x in c}
    kept = []
    for i, (a, b) in enumerate(lines):
        if (a, b) not in gone:
            kept.append((text[a:b], text[b : b + 1]))
            continue
        if i + 1 == len(lines):
            if kept:
                kept[-1] = (kept[-1][0], b"")
        elif text[b : b + 1] == b"\n" and lines[i + 1] not in gone and kept and kept[-1][1] != b"\n":
            kept[-1] = (kept[-1][0], b"\n")
    return b"".join(x + y for x, y in kept), len(lines), len(gone)


def bench_terms(text: bytes) -> list[bytes]:
    return BENCH_WORD.findall(ascii_lower(text))


def ranked(docs: list[tuple[int | None, str | None]], items: list[tuple[int | None, str | None]], k: int = 10) -> list[tuple]:
    """item_id, rank, doc_id and score of the k best documents for each item, every document scored."""
    split = [(d, Counter(bench_terms((t or "").encode()))) for d, t in docs]
    n, length = sum(bool(c) for _, c in split), sum(c.total() for _, c in split)
    df = Counter(t for _, c in split for t in c)
    out = []
    for name, text in set(items):
        asked = bench_terms((text or "").encode())
        found = []
        for d, c in split:
            m = 100 - 75 + 75 * c.total() * n // max(1, length)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if c[t])
            if score > 0:
                found.append((-score, d is None, d))
        out += [(name, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def nearest(rows: list[tuple[int | None, list | None]], k: int = 10, each: int = 100) -> list[tuple]:
    """query_id, rank, vec_id and score: every inner product of scaled vectors."""
    good = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(good):
        if i is not None and i % each == 0:
            found = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), j is None, j or 0) for b, (j, w) in enumerate(good) if a != b)
            out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(found[:k])]
    return out


def word_runs(words: list, least: int = 24, periods: int = 3) -> list[tuple[int, int, int]]:
    """start, length and smallest period of every run, each period in turn."""
    out, seen = [], set()
    for q in range(1, len(words) // periods + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end - at + q >= max(least, periods * q) and (at, end + q) not in seen:
                seen.add((at, end + q))
                out.append((at, end + q - at, q))
            at = end + 1
    return sorted(out)


def run_row(doc_id: int | None, text: str | None) -> tuple:
    """What a text's runs are, after one text in ten was made periodic."""
    words = BLANK_WORD.findall((text or "").encode())
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and n and h % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = word_runs(words)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    return (len(found), *best, None if best[0] is None else 1000 * best[1] // best[2], sha("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))
