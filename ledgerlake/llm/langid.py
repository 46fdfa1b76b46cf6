"""Language identification by cross-parsing.

A text is parsed, from left to right, into the longest phrases that occur in the training text of a language; the
suffix automaton of that text finds them. The language that needs the fewest phrases, normalised to bits a symbol, wins.
The parses of many texts by all languages advance together, a symbol at a time, over one numpy table.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from ledgerlake.llm.automaton import SuffixAutomaton
from ledgerlake.llm.common import by_slice, is_in_fold

#: Characters of training text for each language, and for all together; labelled rows they come from at most. Whole
#: texts are taken until there are so many, those of up to LONG_TEXT characters first.
TRAIN_SYMBOLS, ALL_SYMBOLS, TRAIN_DOCS, LONG_TEXT = 24_000, 500_000, 64, 8_000
#: Long texts are parsed in stretches of so many symbols, side by side, and joined to one parse after; of each stretch,
#: the phrases that begin in its first JOIN symbols are remembered. Both only set the pace.
STRETCH, JOIN = 1024, 256
#: Stretches of long texts that are held at once, times languages.
HELD = 100_000
#: Rows that are parsed together.
ROWS = 4000
HELD_OUT = (4, 2)


class Model:
    """The automata of all languages in one table."""

    def __init__(self, texts: tuple[tuple[str, bytes], ...]):
        self.langs = [k for k, _ in texts]
        seen = sorted({b for _, t in texts for b in t if b >= 128})
        #: Symbol of each byte: 0 for anything that is no letter, letters from 1, bytes of no training text last.
        self.code = np.zeros(256, np.uint8)
        self.code[128:] = 27 + len(seen)
        self.code[97:123] = np.arange(1, 27)
        self.code[seen] = 27 + np.arange(len(seen))
        width = 28 + len(seen)
        rows, self.root, self.bits = [], [], []
        at = 0
        for _, t in texts:
            auto = SuffixAutomaton([self.symbols(t).tolist()])
            n = len(auto.next)
            step = np.full((n, width), -1, np.int64)
            for s, to in enumerate(auto.next):
                step[s, list(to.keys())] = list(to.values())
            none = step < 0
            fresh = np.where(step[0] < 0, 0, step[0])  # a new phrase begins with the symbol that ended the last
            step = np.where(none, fresh[None, :], step)
            none[0] = True  # at the root any symbol begins a phrase
            rows.append((at + step) * width * 2 + none)
            self.root.append(at * width)
            self.bits.append(np.log2(max(2, n)))
            at += n
        table = np.concatenate(rows).ravel() if rows else np.zeros(0, np.int64)
        self.table = table.astype(np.int32) if at * width < 1 << 29 else table

    def symbols(self, text: bytes) -> np.ndarray:
        c = self.code[np.frombuffer(text, np.uint8)]
        return c[np.r_[True, (c[1:] != 0) | (c[:-1] != 0)]] if len(c) else c

    def rates(self, texts: list[bytes]) -> np.ndarray:
        """Bits a symbol of each text, by language."""
        coded = [self.symbols(t) for t in texts]
        size = np.array([len(c) for c in coded], np.int64)
        phrases = np.zeros((len(texts), len(self.langs)), np.int64)
        short = np.flatnonzero(size <= STRETCH)
        phrases[short] = self._advance([coded[i] for i in short])[0].T
        held: list[int] = []
        for i in np.flatnonzero(size > STRETCH).tolist():
            held.append(i)
            if size[held].sum() * len(self.langs) >= HELD * STRETCH:
                phrases[held] = [self._joined(x) for x in self._in_stretches([coded[k] for k in held])]
                held = []
        if held:
            phrases[held] = [self._joined(x) for x in self._in_stretches([coded[k] for k in held])]
        return phrases * np.array(self.bits) / np.maximum(size, 1)[:, None]

    def _advance(self, parts: list[np.ndarray], first: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Parses of parts from their starts, a symbol of all at a time: phrases and last state by language and part,
        and whether a phrase begins at each of the ``first`` symbols."""
        size = np.array([len(c) for c in parts], np.int64)
        order = np.argsort(-size, kind="stable")
        length, start = size[order], (np.cumsum(size) - size)[order]
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
        count = np.zeros((len(self.langs), len(parts)), np.int64)
        marks = np.zeros((len(self.langs), len(parts), first), bool)
        state = np.repeat(np.array(self.root, self.table.dtype)[:, None], len(parts), axis=1)
        longest = int(length[0]) if len(length) else 0
        active = np.searchsorted(-length, -np.arange(1, longest + 1), side="right")
        for t in range(longest):
            n = active[t]
            got = self.table[state[:, :n] + flat[start[:n] + t].astype(self.table.dtype)]
            new = got & 1
            count[:, :n] += new
            if t < first:
                marks[:, :n, t] = new
            state[:, :n] = got >> 1
        back = np.argsort(order)
        return count[:, back], state[:, back], marks[:, back]

    def _in_stretches(self, texts: list[np.ndarray]):
        """Stretches of each text, with what :meth:`_advance` says of them."""
        parts = [[c[k : k + STRETCH] for k in range(0, len(c), STRETCH)] for c in texts]
        count, state, marks = self._advance([p for ps in parts for p in ps], JOIN)
        at = 0
        for ps in parts:
            yield ps, count[:, at : at + len(ps)], state[:, at : at + len(ps)], marks[:, at : at + len(ps)]
            at += len(ps)

    def _joined(self, x) -> list[int]:
        """Phrases of the parse of a whole text, by language.

        The phrase that is open at the end of a stretch is carried into the next one, symbol by symbol, until a phrase
        begins where one of that stretch's own parse does; from there on the two are the same.
        """
        parts, count, state, marks = x
        out = []
        for k in range(len(self.langs)):
            total, at = int(count[k, 0]), int(state[k, 0])
            for p in range(1, len(parts)):
                begun, met = 0, False
                for t, c in enumerate(parts[p].tolist()):
                    got = int(self.table[at + c])
                    at = got >> 1
                    if got & 1:
                        if t < JOIN and marks[k, p, t]:
                            met = True
                            break
                        begun += 1
                if met:
                    total += begun + int(count[k, p]) - int(marks[k, p, :t].sum())
                    at = int(state[k, p])
                else:
                    total += begun
            out.append(total)
        return out


@lru_cache(maxsize=1)
def model(texts: tuple[tuple[str, bytes], ...]) -> Model:
    return Model(texts)


def train(labelled: DataFrame) -> tuple[tuple[str, bytes], ...]:
    """Training text of each language, from a bounded sample of rows with text and lang.

    For each language, the TRAIN_DOCS rows with the lowest hash of doc_id are ordered by it and give whole texts until
    TRAIN_SYMBOLS characters, or the language's share of ALL_SYMBOLS, are passed. Texts over LONG_TEXT characters come
    after all others, the shortest first, so that one of them is taken only where a language has no other, and then
    LONG_TEXT characters of it from a place that a hash of doc_id chooses. A text met before is passed over. Rows without text, lang or doc_id are not used.
    """
    ids = labelled.filter("lang is not null and text is not null and doc_id is not null").select("lang", "doc_id", F.length("text").alias("size"))
    long = F.when(F.col("size") > LONG_TEXT, F.col("size")).otherwise(0)
    best = Window.partitionBy("lang").orderBy(long, F.xxhash64("doc_id"), "doc_id", "size")
    rows = ids.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= TRAIN_DOCS).collect()
    order: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.n)):
        order.setdefault(r.lang, []).append(r)
    budget = min(TRAIN_SYMBOLS, ALL_SYMBOLS // max(1, len(order)))
    wanted, chosen = {}, []
    for lang, rs in order.items():
        total = 0
        for r in rs:
            if total >= budget or (total and r.size > LONG_TEXT):
                break
            total += r.size
            wanted[lang, r.doc_id, r.size] = r.n
            chosen.append((lang, r.doc_id, r.size))
    if not chosen:
        return ()
    kinds = ids.schema
    picked = labelled.sparkSession.createDataFrame(list(dict.fromkeys(chosen)), kinds)
    size = F.length("text")
    piece = F.substring("text", (1 + F.pmod(F.xxhash64("doc_id"), F.greatest(size - LONG_TEXT, F.lit(1)))).cast("int"), F.lit(LONG_TEXT))
    low = labelled.select("lang", "doc_id", size.alias("size"), F.lower(F.when(size > LONG_TEXT, piece).otherwise(F.col("text"))).alias("text"))
    sample = low.join(F.broadcast(picked), kinds.names, "left_semi").distinct().collect()
    texts: dict[str, list[bytes]] = {}
    for r in sorted(sample, key=lambda r: (r.lang, wanted[r.lang, r.doc_id, r.size], r.text)):
        have = texts.setdefault(r.lang, [])
        if r.text.encode() not in have:
            have.append(r.text.encode())
    return tuple((k, b" ".join(v)) for k, v in sorted(texts.items()))


def predict(docs: DataFrame, texts: tuple[tuple[str, bytes], ...], keep_columns: bool = False, prefix: str = "") -> DataFrame:
    """Language of every whole text.

    docs: doc_id, text; further columns are ignored, or kept before the results if ``keep_columns``; ``prefix`` is put
    before the names of the results, for tables that have such columns already. Returns doc_id,
    lang_pred, score (0 to 1: by how much the second-best language needs more bits, relative to it) and rate (bits a
    symbol of the best). lang_pred is ``und`` and score 0 where the text is null or has no letter, and everywhere if
    no language was learned. Ties go to the first language in order of name. Repeated rows are each judged. No shuffle.
    """
    schema = (docs.select("*").schema if keep_columns else docs.select("doc_id").schema).add(f"{prefix}lang_pred", "string").add(f"{prefix}score", "double").add(f"{prefix}rate", "double")
    kept = docs.columns if keep_columns else ["doc_id"]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.lower("text").cast("binary").alias("__low"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__letters"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        letters = np.array(batch.column(len(kept) + 1).to_pylist(), bool)
        if not texts:
            lang, score, rate = ["und"] * n, np.zeros(n), np.zeros(n)
        else:
            m = model(texts)
            got = m.rates([t or b"" if ok else b"" for t, ok in zip(batch.column(len(kept)).to_pylist(), letters, strict=True)])
            best = got.argmin(axis=1)
            rate = got[np.arange(n), best]
            second = np.partition(got, 1, axis=1)[:, 1] if len(m.langs) > 1 else np.full(n, np.inf)
            score = np.where(letters, 1 - rate / np.maximum(second, 1e-9), 0.0).clip(0, 1)
            lang = [m.langs[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
        return pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(lang), pa.array(score), pa.array(rate)], schema=to)

    to = to_arrow_schema(schema)
    return rows.mapInArrow(by_slice(work, ROWS), schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, learned from the rows that are not held out."""
    held_out = is_in_fold(*HELD_OUT)
    texts = train(docs.filter(~held_out))
    got = predict(docs, texts)
    return got.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """docs without the rows that are ``und``, learned from those not held out. All columns are kept, in order."""
    got = predict(docs, train(docs.filter(~is_in_fold(*HELD_OUT))), keep_columns=True, prefix="__")
    return got.filter("__lang_pred <> 'und'").select(*docs.columns)
