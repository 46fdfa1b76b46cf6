"""SimHash near-duplicate detection with pigeonring filtering.

64-bit fingerprints are cut into four segments on a ring. If two differ in at most three bits, some segment starts a
chain whose cumulative differences stay within the proportional budget 3/4 a segment: none in the first, at most one in
the first two, at most two in the first three. The pairs for which all of a chain's prefixes hold share one of 24 keys:
the first segment, one half of the second and one third of the third. Only within a key are fingerprints compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import by_slice, join_counted, keyed, stash
from ledgerlake.llm.components import components

SHINGLE, SEED, MAX_BITS = 3, 42, 3
SEGMENT = 16
#: Fingerprints that are compared within one key; larger groups are told apart by further bits first.
GROUP = 4096
#: Bit positions of a third of a segment and of its halves.
THIRDS, HALVES = ((0, 5), (5, 10), (10, 16)), ((0, 8), (8, 16))
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes) -> int:
    words = text.translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s, SEED) for s in shingles], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 4096):
        ones += np.unpackbits(h[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, tid and fp (the fingerprint as a signed long) of every row of docs; null texts have fingerprint zero."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        fp = np.array([fingerprint(t or b"") for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], ["doc_id", "tid", "fp"])

    return keyed(docs).mapInArrow(by_slice(work), f"doc_id {kind}, tid bigint, fp bigint")


def _ring_masks() -> list[int]:
    """The bits of each of the 24 keys."""
    masks = []
    for i in range(4):
        for half in HALVES:
            for third in THIRDS:
                m = ((1 << SEGMENT) - 1) << (SEGMENT * i)
                for k, (lo, hi) in ((1, half), (2, third)):
                    m |= (((1 << hi) - (1 << lo)) << (SEGMENT * ((i + k) % 4)))
                masks.append(m)
    return masks


def _chain(first: int) -> tuple[int, int]:
    """Bits of the second, and of the second and third, segment of the chain that starts at segment ``first``."""
    one = (1 << SEGMENT) - 1
    two = one << SEGMENT * ((first + 1) % 4)
    return two, two | one << SEGMENT * ((first + 2) % 4)


def _narrower(mask: int) -> list[int]:
    """Keys that add, to a key's bits, one of the four parts of the bits that it leaves open; three differences miss one part."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [round(len(free) * k / 4) for k in range(5)]
    return [mask | sum(1 << b for b in free[lo:hi]) for lo, hi in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links_within(fps: np.ndarray, first: int) -> list[tuple[int, int]]:
    """Edges that connect what is connected among distinct fingerprints by pairs with a chain from segment ``first``.

    Each fingerprint is held against those not yet reached: the chain's cumulative differences prune, then comes the
    full Hamming check. There is one edge for each fingerprint but the first of a component.
    """
    two, three = (np.uint64(m) for m in _chain(first))
    out, left = [], fps.view(np.uint64)
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count((left ^ x) & two) <= 1
            near[near] = np.bitwise_count((left[near] ^ x) & three) <= 2
            near[near] = np.bitwise_count(left[near] ^ x) <= MAX_BITS
            if near.any():
                found = left[near]
                out += [(x, y) for y in found]
                front += list(found)
                left = left[~near]
    return out


def links(fps: DataFrame) -> DataFrame:
    """Edges a, b between fingerprints (column fp, distinct) that span the components of the graph of near ones.

    Fingerprints that share a key go to one task, unless there are over GROUP of them: those are keyed anew by further
    bits, again and again, until a key leaves so few bits open that its group is bounded. No pair is lost by that.
    """
    found = []
    keys = F.array(*[F.struct(F.lit(_signed(m)).alias("mask"), F.lit(k // 6).alias("first")) for k, m in enumerate(_ring_masks())])
    todo = fps.select("fp", F.inline(keys))
    while True:
        keyed_rows = todo.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        counts = keyed_rows.groupBy("first", "mask", "key").count().filter("count > 1")
        wide = stash(counts.filter(F.col("count") > GROUP), "wide")
        narrow = keyed_rows.join(counts.filter(F.col("count") <= GROUP).select("first", "mask", "key"), ["first", "mask", "key"])

        def work(batches):
            rest = None
            for batch in batches:
                table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
                first, mask, key, fp = (table.column(c).to_numpy() for c in ("first", "mask", "key", "fp"))
                ends = np.flatnonzero((first[1:] != first[:-1]) | (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
                yield from _edges(first, fp, np.r_[0, ends])
                last = int(ends[-1]) if len(ends) else 0
                rest = table.slice(last).combine_chunks()
            if rest is not None and rest.num_rows:
                yield from _edges(rest.column("first").to_numpy(), rest.column("fp").to_numpy(), np.array([0, rest.num_rows]))

        sorted_rows = narrow.select("first", "mask", "key", "fp").repartition("first", "mask", "key").sortWithinPartitions("first", "mask", "key")
        edges = sorted_rows.mapInArrow(work, "a bigint, b bigint")
        if wide.isEmpty():
            found.append(edges)
            break
        found.append(stash(edges, "links"))
        hot = keyed_rows.join(wide.select("first", "mask", "key"), ["first", "mask", "key"]).select("fp", "first", "mask")
        narrower = [(r.mask, _signed(x)) for r in wide.select("mask").distinct().collect() for x in dict.fromkeys(_narrower(r.mask & (1 << 64) - 1))]
        steps = fps.sparkSession.createDataFrame(narrower, "mask bigint, narrower bigint")
        todo = stash(hot.join(F.broadcast(steps), "mask").select("fp", "first", F.col("narrower").alias("mask")), "narrower")
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def _edges(first: np.ndarray, fp: np.ndarray, bounds: np.ndarray):
    pairs = [p for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True) for p in links_within(fp[lo:hi], int(first[lo]))]
    if pairs:
        a, b = np.array(pairs, np.uint64).view(np.int64).T
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Components of documents whose fingerprints are linked at MAX_BITS or fewer differing bits.

    docs: doc_id, text; further columns are ignored. Returns for each row doc_id, tid, fp, root (a fingerprint that
    stands for the component) and component_id (the smallest doc_id in it). Null and empty texts share fingerprint
    zero and are linked like any other; repeated rows come back each. Equal fingerprints are one node, so copies are
    never expanded into pairs. An empty table gives an empty result.
    """
    rows = stash(fingerprints(docs), "fingerprints")
    classes = stash(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "classes")
    roots = components(links(classes.select("fp")))
    named = classes.join(roots, classes.fp == roots.node, "left").select("fp", "low", "n", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = stash(named.join(least, "root").select("fp", "n", "root", "component_id"), "named")
    return join_counted(rows, named, ["fp"], "n").select("doc_id", "tid", "fp", "root", "component_id")


def report(found: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of the rows of :func:`near_duplicates`."""
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one document of each component: that with the smallest doc_id. All columns are kept, in order.

    A null doc_id stands after all others. Of rows that repeat both id and text one stays.
    """
    found = near_duplicates(docs)
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tid")).alias("k")).select("k.doc_id", "k.tid")
    best = best.select(F.col("doc_id").alias("__doc_id"), F.col("tid").alias("__tid"))
    rows = docs.withColumn("__text_id", F.xxhash64("text"))
    kept = rows.join(best, rows["doc_id"].eqNullSafe(best["__doc_id"]) & (rows["__text_id"] == best["__tid"]), "left_semi")
    return kept.dropDuplicates(["doc_id", "__text_id"]).select(*docs.columns)
