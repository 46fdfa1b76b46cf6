"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A byte pair that occurs inside no vocabulary token can be spanned by no merge, so a text may be cut between the two
bytes and the fragments encoded one by one. Where the left byte is no white space and the right one is a space, the
pre-tokeniser cuts as well, whatever stands around; those pairs cut a whole text into short fragments that repeat
often and are looked up. A fragment seen for the first time is pre-tokenised, cut at all other forced pairs, and merged.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import by_slice

#: Fragments of up to KNOWN bytes that a worker remembers, 40 MB at most; when full it starts anew. Longer ones are
#: merged each time. Neither changes a result.
CACHE, KNOWN = 200_000, 48
#: Bytes up to which pieces are merged many at a time.
SHORT = 200
#: White space outside ASCII, as patterns of bytes: no cut between one and a space, for they may be one piece.
ODD_SPACES = (rb"\xc2[\x85\xa0]", rb"\xe1\x9a\x80", rb"\xe2\x80[\x80-\x8a\xa8\xa9\xaf]", rb"\xe2\x81\x9f", rb"\xe3\x80\x80")
# Fixed value: the pre-tokeniser's pattern of the byte-level vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte, as byte-level vocabularies write them: printable Latin-1 stands for itself."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Known(dict):
    """Ids of fragments: special tokens, those that are remembered, and those of the texts at hand."""

    def __init__(self, special: dict[bytes, bytes]):
        super().__init__(special)
        self.special, self.at_hand = special, {}

    def __missing__(self, fragment: bytes) -> bytes:
        return self.at_hand[fragment]

    def forget(self) -> None:
        self.clear()
        self.update(self.special)

    def learn(self, ids: dict[bytes, bytes]) -> None:
        self.at_hand = ids
        self.update((x, i) for x, i in ids.items() if len(x) <= KNOWN)


class ByteBPE:
    """Encoder and decoder for one tokenizer file; built once in each worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"].encode(): t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: bytes(alphabet[c] for c in t) for t, i in vocab.items() if all(c in alphabet for c in t)}
        self.bytes_of |= {i: t for t, i in self.special.items()}
        self.of_byte = [vocab[c] for c, _ in sorted(alphabet.items(), key=lambda x: x[1])]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.rank = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self._build_table()
        inside = {t[i : i + 2] for k, t in self.bytes_of.items() if t not in self.special for i in range(len(t) - 1)}
        self.never = np.ones((256, 256), bool)
        for a, b in inside:
            self.never[a, b] = False
        left = [a for a in (*range(0x21, 0x7F), *range(0x80, 0xC0)) if self.never[a, 0x20]]
        self.no_cut = re.compile(b"[" + b"".join(re.escape(bytes([a])) for a in range(256) if a not in set(left)) + b"] ")
        self.cut = re.compile(b"".join(b"(?<!" + x + b")" for x in ODD_SPACES) + b"(?<=[" + b"".join(re.escape(bytes([a])) for a in left) + b"])(?= )")
        self.odd = re.compile(b"|".join(x + b" " for x in ODD_SPACES))
        self.words = regex.compile(PATTERN)
        self.specials = re.compile(b"(" + b"|".join(map(re.escape, self.special)) + b")") if self.special else None
        self.known = Known({s: array("i", [i]).tobytes() for s, i in self.special.items()})

    def _build_table(self) -> None:
        """Open-addressed arrays that find the merges of many pairs at once."""
        keys = np.array([a << 32 | b for a, b in self.rank], np.int64)
        bits = int(len(keys)).bit_length() + 2
        self.shift, self.key, self.at = np.uint64(64 - bits), np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        self.new_id = np.array([x[1] for x in self.rank.values()], np.int32)
        left = np.arange(len(keys))
        slot = self._slot(keys)
        while len(left):
            free = self.key[slot[left]] < 0
            _, first = np.unique(slot[left], return_index=True)
            put = left[np.intersect1d(first, np.flatnonzero(free))]
            self.key[slot[put]], self.at[slot[put]] = keys[put], put
            left = np.setdiff1d(left, put)
            slot[left] = (slot[left] + 1) & (len(self.key) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; the number of merges where there is none."""
        keys = a.astype(np.int64) << 32 | b
        slot, out = self._slot(keys), np.full(len(keys), len(self.new_id), np.int32)
        todo = np.arange(len(keys))
        while len(todo):
            found = self.key[slot[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.at[slot[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
            slot[todo] = (slot[todo] + 1) & (len(self.key) - 1)
        return out

    def _merge_long(self, piece: bytes) -> list[int]:
        """Ids of one piece of any length: a heap yields the lowest rank, the leftmost among equals."""
        ids = [self.of_byte[b] for b in piece]
        after, before, gone = list(range(1, len(ids))) + [-1], list(range(-1, len(ids) - 1)), [False] * len(ids)
        heap = [(*m, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (m := self.rank.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, new, i, a, b = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], gone[j], after[i] = new, True, after[j]
            if (k := after[i]) >= 0:
                before[k] = i
                if m := self.rank.get((new, ids[k])):
                    heapq.heappush(heap, (*m, i, new, ids[k]))
            if (h := before[i]) >= 0 and (m := self.rank.get((ids[h], new))):
                heapq.heappush(heap, (*m, h, ids[h], new))
        return [x for x, g in zip(ids, gone, strict=True) if not g]

    def _merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of many short pieces, each cut at forced pairs: in every round each fragment does its next merge."""
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        size = np.array([len(p) for p in pieces], np.int64)
        piece = np.repeat(np.arange(len(pieces)), size)
        begins = np.r_[True, (piece[1:] != piece[:-1]) | self.never[raw[:-1], raw[1:]]]
        part, ids = np.cumsum(begins) - 1, np.array(self.of_byte, np.int32)[raw]
        done, none = [], len(self.new_id)
        while len(ids):
            rank = np.full(len(ids), none, np.int32)
            inner = np.flatnonzero(part[1:] == part[:-1])
            rank[inner] = self._ranks(ids[inner], ids[inner + 1])
            starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            low = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(ids)]))
            over = low == none
            done.append((piece[over], part[over], ids[over]))
            at = np.flatnonzero((rank == low) & ~over)
            at = at[np.r_[True, part[at][1:] != part[at][:-1]]] if len(at) else at
            ids[at] = self.new_id[rank[at]]
            keep = ~over
            keep[at + 1] = False
            piece, part, ids = piece[keep], part[keep], ids[keep]
        piece, part, ids = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(part, kind="stable")
        flat, ends = ids[order].tobytes(), 4 * np.cumsum(np.bincount(piece, minlength=len(pieces)))
        return [flat[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]

    def _ids(self, fragments: set[bytes]) -> dict[bytes, bytes]:
        """Ids of fragments that the pre-tokeniser would cut off as well."""
        words = {}
        for x in fragments:
            t = x.decode()
            words[x] = [x] if t[t[:1] == " " :].isalpha() else [w.encode() for w in self.words.findall(t)]
        pieces = list({w for ws in words.values() for w in ws})
        short = [w for w in pieces if len(w) <= SHORT]
        ids = dict(zip(short, self._merge(short) if short else [], strict=True))
        ids |= {w: self._cut_long(w) for w in pieces if len(w) > SHORT}
        return {x: b"".join([ids[w] for w in ws]) for x, ws in words.items()}

    def _cut_long(self, piece: bytes) -> bytes:
        b = np.frombuffer(piece, np.uint8)
        cuts = (np.flatnonzero(self.never[b[:-1], b[1:]]) + 1).tolist()
        return array("i", [i for lo, hi in zip([0, *cuts], [*cuts, len(piece)], strict=True) for i in self._merge_long(piece[lo:hi])]).tobytes()

    def _split(self, text: bytes) -> list[bytes]:
        """Fragments at whose ends the pre-tokeniser cuts whatever stands around."""
        if self.no_cut.search(text) or self.odd.search(text):
            return self.cut.split(text)
        head, *tail = text.split(b" ")
        return [head, *[b" " + x for x in tail]]

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """Ids of whole texts, packed as 32-bit numbers."""
        split = []
        for t in texts:
            whole = self.specials is None or not any(s in t for s in self.special)
            split.append(self._split(t) if whole else [y for x in self.specials.split(t) for y in ([x] if x in self.special else self._split(x))])
        if len(self.known) > CACHE:
            self.known.forget()
        self.known.learn(self._ids(set().union(*split) - self.known.keys()))
        return [b"".join(map(self.known.__getitem__, x)) for x in split]

    def decode(self, ids: bytes) -> str:
        """Text of packed ids, special tokens included."""
        return b"".join(map(self.bytes_of.__getitem__, array("i", ids))).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def loaded(path: str) -> ByteBPE:
    return ByteBPE(path)


def encode_decode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Token ids of every whole text, and the text decoded from them.

    docs: doc_id, text and any further columns, which are not returned. tokenizer_path: a byte-level BPE file in the
    tokenizers library's JSON format, present on every executor. Returns doc_id, token_ids (array of int) and decoded
    (string), a row for each row of docs. A null or empty text has no ids and decodes to the empty string; repeated
    rows are each encoded; null ids are kept; an empty table gives an empty result. No shuffle.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = loaded(tokenizer_path)
        done = coder.encode_all([t or b"" for t in batch.column(1).to_pylist()])
        ends = np.cumsum([0] + [len(x) // 4 for x in done]).astype(np.int32)
        ids = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(done), np.int32)))
        text = pa.array([coder.decode(x) for x in done], pa.string())
        return pa.RecordBatch.from_arrays([batch.column(0), ids, text], ["doc_id", "token_ids", "decoded"])

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    # a worker that sits idle afterwards holds no vocabulary and no fragments
    return rows.mapInArrow(by_slice(work, after=lambda: loaded.cache_clear()), f"doc_id {kind}, token_ids array<int>, decoded string")


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, further columns, n_tokens, ids_sha256 and decoded_sha256 of the rows of :func:`encode_decode`."""
    return encoded.select(
        "doc_id",
        *more,
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("token_ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
