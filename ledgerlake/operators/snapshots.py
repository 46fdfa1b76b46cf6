"""Block-boundary snapshots: where they fall, what they hold, and resuming from them (survey W3, W4, M6, M11-M13)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlake.functions import u256
from ledgerlake.lineage import cut
from ledgerlake.operators.asof import as_of
from ledgerlake.operators.ledger import FEW, at_marks, block_deltas, block_sums, by_block, moves, rendered, running_sums, standing, sums_at, touched_blocks, watched

EVENTS, BLOCKS = 10_000, 10_000
KEY = ["chain_id", "address"]
POINTER = "chain_id bigint, address string, as_of bigint, revision int, begin bigint, seen bigint, processed bigint"
#: Stands for no snapshot: before every block.
NEVER = -1
#: Blocks with facts from which an account is many tasks, and blocks or facts of a bucket then.
LARGE, SPAN = 1_000_000, 100_000


def _segments(counts: DataFrame, events: int, blocks: int) -> DataFrame:
    """chain_id, address, block, is_boundary, and for an account's last row begin and seen, the state of its open segment.

    counts: chain_id, address, block, n (its facts), begin and seen (of the segment that is open before; null at first).
    From a cut, the next is at the first block at which ``events`` facts or ``blocks`` blocks have come since: both are
    found by binary search over running sums. Accounts are walked from cut to cut, a sorted partition at a time; those of more than LARGE
    blocks with facts go by :func:`_pointed`, as many tasks.
    """
    events, blocks = max(1, events), max(1, blocks)
    large = cut(counts.groupBy(*KEY).agg(F.count("*").alias("__n")).filter(F.col("__n") > LARGE).select(*KEY))
    if large.isEmpty():
        return _walked(counts, events, blocks)
    return _walked(counts.join(large, KEY, "left_anti"), events, blocks).unionByName(_pointed(cut(counts.join(large, KEY, "left_semi")), events, blocks))


def _walked(counts: DataFrame, events: int, blocks: int) -> DataFrame:
    names = ["chain_id", "address", "block", "is_boundary", "begin", "seen"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        account, begin, seen, last = None, 0, 0, 0
        closed = lambda: (*account, last, seen > 0, begin, seen)
        for batch in batches:
            out: list[tuple] = []
            chain, address = batch.column(0), batch.column(1)
            block, n = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            other = lambda c: pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
            starts = [0, *(np.flatnonzero(other(address) | other(chain)) + 1).tolist()] if len(block) else []
            for lo, hi in zip(starts, [*starts[1:], len(block)], strict=True):
                if (now := (chain[lo].as_py(), address[lo].as_py())) != account:
                    if account is not None:
                        out.append(closed())
                    before, held = batch.column(4)[lo].as_py(), batch.column(5)[lo].as_py()
                    account, begin, seen = now, int(block[lo]) if before is None else before, held or 0
                b, sums = block[lo:hi], np.cumsum(n[lo:hi])
                at, done = 0, 0
                while at < len(b):
                    k = max(at, min(int(np.searchsorted(sums, done + events - seen)), int(np.searchsorted(b, begin + blocks - 1))))
                    if k >= len(b):
                        break
                    out.append((*account, int(b[k]), True, None, None))
                    begin, seen, at, done = int(b[k]) + 1, 0, k + 1, int(sums[k])
                seen, last = seen + int(sums[-1]) - done, int(b[-1])
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names)
        if account is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(closed(), types, strict=True)], names)

    ordered = counts.repartition("address", "chain_id").sortWithinPartitions("address", "chain_id", "block").select(*KEY, "block", "n", "begin", "seen")
    return ordered.mapInArrow(walk, "chain_id bigint, address string, block bigint, is_boundary boolean, begin bigint, seen bigint")


def _pointed(counts: DataFrame, events: int, blocks: int) -> DataFrame:
    """:func:`_walked` for accounts with very many blocks: every block points to the cut that would follow one at it.

    Pointers come from two as-of lookups, over running sums and over blocks, in buckets. Then jumps are doubled: after k
    rounds the first 2^k cuts are known, so that a history of any length takes few joins.
    """
    of = F.floor(F.col("block") / SPAN)
    by = counts.withColumn("__of", of).groupBy(*KEY, "__of").agg(F.sum("n").alias("__n"))
    before = by.select(*KEY, "__of", F.coalesce(F.sum("__n").over(Window.partitionBy(*KEY).orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    run = Window.partitionBy(*KEY, "__of").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    sums = cut(counts.withColumn("__of", of).join(before, [*KEY, "__of"]).select(*KEY, "block", "begin", "seen", (F.col("__before") + F.sum("n").over(run)).alias("sum")))
    first = sums.groupBy(*KEY).agg(F.min("block").alias("__first"), F.max("begin").alias("__begin"), F.max("seen").alias("__seen"), F.max("block").alias("__last"), F.max("sum").alias("__all"))
    start = first.select(*KEY, F.lit(NEVER).cast("bigint").alias("block"), (events - F.coalesce("__seen", F.lit(0))).cast("bigint").alias("want"), (F.coalesce("__begin", "__first") + blocks - 1).cast("bigint").alias("reach"))
    asked = sums.select(*KEY, "block", (F.col("sum") + events).alias("want"), (F.col("block") + blocks).alias("reach")).unionByName(start)
    found = lambda at, point, width: as_of(asked.select(*KEY, F.col(at).alias("at"), "block"), sums.select(*KEY, F.col(point).alias("at"), F.col("block").alias("cut")), KEY, "after", at="at", position=F.col("at").cast("bigint"), width=width, unit=1).select(*KEY, "block", F.col("point.cut").alias(at))
    jump = cut(found("want", "sum", max(SPAN, events)).join(found("reach", "block", SPAN), [*KEY, "block"]).select(*KEY, "block", F.least("want", "reach").alias("next")).filter("next is not null"))
    met, n = start.select(*KEY, "block"), 0
    while True:
        met = cut(met.unionByName(met.join(jump, [*KEY, "block"]).select(*KEY, F.col("next").alias("block"))).distinct())
        if (now := met.count()) == n:
            break
        n = now
        jump = cut(jump.join(jump.select(*KEY, F.col("block").alias("next"), F.col("next").alias("__next")), [*KEY, "next"]).select(*KEY, "block", F.col("__next").alias("next")))
    cuts, none = met.filter(F.col("block") != NEVER), F.lit(None).cast("bigint")
    ends = cuts.join(sums.select(*KEY, "block", "sum"), [*KEY, "block"]).groupBy(*KEY).agg(F.max("block").alias("__cut"), F.max("sum").alias("__done"))
    state = first.join(ends, KEY, "left").select(*KEY, F.col("__last").alias("block"), F.coalesce(F.col("__cut") + 1, "__begin", "__first").alias("begin"), F.when(F.col("__cut").isNull(), F.col("__all") + F.coalesce("__seen", F.lit(0))).otherwise(F.col("__all") - F.col("__done")).alias("seen"))
    return cuts.select(*KEY, "block", F.lit(True).alias("is_boundary"), none.alias("begin"), none.alias("seen")).unionByName(state.select(*KEY, "block", (F.col("seen") > 0).alias("is_boundary"), "begin", "seen"))


def _counts(transfers: DataFrame) -> DataFrame:
    """chain_id, address, block and n, the facts of an account in a block; one of an account to itself counts once."""
    return watched(transfers.select("chain_id", "from_address", "to_address", "block")).filter("address is not null").groupBy(*KEY, "block").agg(F.count("*").alias("n"))


def _every(events: int, blocks: int) -> bool:
    """Whether a snapshot falls at each block with facts, so that nothing need be walked."""
    return events <= 1 or blocks <= 1


def _boundaries(counts: DataFrame, events: int, blocks: int) -> DataFrame:
    nothing = F.lit(None).cast("bigint")
    rows = _segments(counts.withColumn("begin", nothing).withColumn("seen", nothing), events, blocks)
    return rows.filter("is_boundary").select(*KEY, "block").distinct()


def boundaries(transfers: DataFrame, events: int = EVENTS, blocks: int = BLOCKS) -> DataFrame:
    """chain_id, address and block of every snapshot.

    One falls at a block's end when ``events`` facts or ``blocks`` blocks came since the last, and at the last block.
    """
    if _every(events, blocks):
        return _counts(transfers).select(*KEY, "block")
    return _boundaries(cut(_counts(transfers)), events, blocks)


def _hubs(counts: DataFrame, marks: DataFrame) -> DataFrame:
    """Accounts of more than LARGE facts or FEW marks: their histories are cut up by as-of lookups; others shuffle once, whole."""
    much = counts.groupBy(*KEY).agg(F.sum("n").alias("__n")).filter(F.col("__n") > LARGE).select(*KEY)
    many = marks.groupBy(*KEY).agg(F.count("*").alias("__n")).filter(F.col("__n") > FEW).select(*KEY)
    return cut(much.unionByName(many).distinct())


def _by(rows: DataFrame, hubs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of accounts that are no hubs, and of hubs."""
    return rows.join(hubs, KEY, "left_anti"), rows.join(hubs, KEY, "left_semi")


def _forever(moved: DataFrame) -> DataFrame:
    return moved.withColumn("until", F.lit(None).cast("bigint"))


def take(transfers: DataFrame, events: int = EVENTS, blocks: int = BLOCKS) -> DataFrame:
    """Snapshots at all boundaries. Facts are counted by block for the boundaries, and summed for the balances."""
    counts = cut(_counts(transfers))
    at = cut(_boundaries(counts, events, blocks))
    moved, hubs = _forever(moves(transfers)), _hubs(counts, at)
    if hubs.isEmpty():
        return standing(moved, at)
    few, many = _by(at, hubs)
    sums = cut(block_sums(transfers).drop("n").join(hubs, KEY, "left_semi"))
    return standing(_by(moved, hubs)[0], few).unionByName(rendered(sums_at(sums, many, sums.select(*KEY, "block")), amount="balance"))


def snapshots(transfers: DataFrame, at: DataFrame) -> DataFrame:
    """Balances of each account at each of its boundaries (chain_id, address, block); boundaries are computed once."""
    return rendered(at_marks(transfers, cut(at.select(*KEY, "block").distinct())), amount="balance")


def replay(transfers: DataFrame, to_block: int, revision: int, events: int = EVENTS, blocks: int = BLOCKS, earlier: DataFrame | None = None) -> DataFrame:
    """Snapshots of facts up to a block under a revision; ``earlier`` ones of that revision are kept and resumed after."""
    if earlier is None:
        return take(transfers.filter(F.col("block") <= to_block), events, blocks).withColumn("revision", F.lit(revision))
    newest = earlier.groupBy(*KEY).agg(F.max("block").alias("as_of"))
    held = newest.select(*KEY, "as_of", F.lit(revision).alias("revision"), (F.col("as_of") + 1).alias("begin"), F.lit(0).cast("bigint").alias("seen"), F.lit(0).cast("bigint").alias("processed"))
    return earlier.unionByName(resume(transfers, to_block, earlier, held, events, blocks)[0].select(*earlier.columns))


def start(transfers: DataFrame, to_block: int, revision: int, events: int = EVENTS, blocks: int = BLOCKS) -> tuple[DataFrame, DataFrame]:
    """Snapshots of all facts up to a block, and the pointer of each account, from which :func:`resume` goes on.

    The pointer: chain_id, address, as_of (the last block with facts), revision, begin and seen (of the segment open
    there), processed (facts replayed).
    """
    nothing = transfers.sparkSession.createDataFrame([], POINTER)
    none = transfers.sparkSession.createDataFrame([], "chain_id bigint, address string, token_address string, block bigint, amount string, revision int")
    return resume(transfers, to_block, none, nothing, events, blocks, revision)


def resume(transfers: DataFrame, to_block: int, taken: DataFrame, pointer: DataFrame, events: int = EVENTS, blocks: int = BLOCKS, revision: int = 0) -> tuple[DataFrame, DataFrame]:
    """New snapshots of facts after each account's pointer, and the pointers after; no fact before them is read again.

    A balance is that of the account's newest snapshot plus what moved since. Segments go on from where they stood, so
    boundaries are those of one replay of everything, and in addition the last blocks of the earlier ones. Accounts
    without a pointer start at ``revision``.
    """
    facts = transfers.filter(F.col("block") <= to_block)
    old = pointer.select(*KEY, F.col("as_of").alias("__as_of"), "begin", "seen", "revision")
    since = old.select(*KEY, "__as_of")
    later = F.col("__as_of").isNull() | (F.col("block") > F.col("__as_of"))
    counts = cut(_counts(facts).join(old, KEY, "left").filter(later))
    rows = cut(_segments(counts, events, blocks))
    marks = rows.filter("is_boundary").select(*KEY, "block").distinct()
    newest = taken.join(taken.groupBy(*KEY).agg(F.max("block").alias("block")), [*KEY, "block"])
    held = newest.join(marks.select(*KEY).distinct(), KEY, "left_semi").select(*KEY, "token_address", "block", "amount")
    made = _resumed(facts, since, counts, marks, held)
    told = pointer.select(*KEY, "revision")
    made = made.join(told, KEY, "left").withColumn("revision", F.coalesce("revision", F.lit(revision)))
    return made.select(*KEY, "token_address", "block", "amount", "revision"), _after(pointer, _ends(counts, rows), revision)


def _ends(counts: DataFrame, rows: DataFrame) -> DataFrame:
    """Where accounts' segments (rows of :func:`_segments`) end, and n, their facts."""
    done = counts.groupBy(*KEY).agg(F.sum("n").alias("n"))
    return rows.filter("begin is not null").select(*KEY, F.col("block").alias("__block"), F.col("begin").alias("__begin"), F.col("seen").alias("__seen")).join(done, KEY)


def _after(pointer: DataFrame, ends: DataFrame, revision: int) -> DataFrame:
    both = pointer.join(ends, KEY, "full")
    return both.select(*KEY, F.coalesce("__block", "as_of").alias("as_of"), F.coalesce("revision", F.lit(revision)).alias("revision"), F.coalesce("__begin", "begin").alias("begin"), F.coalesce("__seen", "seen").alias("seen"), (F.coalesce("processed", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("processed"))


def replayed(transfers: DataFrame, to_block: int, revision: int, events: int = EVENTS, blocks: int = BLOCKS) -> DataFrame:
    """The pointers of :func:`start` alone, where no balances are asked for: facts are counted, and none are summed."""
    facts, nothing = transfers.filter(F.col("block") <= to_block), F.lit(None).cast("bigint")
    if _every(events, blocks):
        sides = watched(facts.select("chain_id", "from_address", "to_address", "block")).filter("address is not null")
        ends = sides.groupBy(*KEY).agg(F.max("block").alias("__block"), (F.max("block") + 1).alias("__begin"), F.lit(0).cast("bigint").alias("__seen"), F.count("*").alias("n"))
    else:
        counts = cut(_counts(facts))
        ends = _ends(counts, _segments(counts.withColumn("begin", nothing).withColumn("seen", nothing), events, blocks))
    return _after(transfers.sparkSession.createDataFrame([], POINTER), ends, revision)


def _resumed(facts: DataFrame, since: DataFrame, counts: DataFrame, marks: DataFrame, held: DataFrame) -> DataFrame:
    """Balances at marks: what an account held (a snapshot's rows) plus what moved after its ``__as_of``."""
    later = lambda rows: rows.join(since, KEY, "left").filter(F.col("__as_of").isNull() | (F.col("block") > F.col("__as_of"))).drop("__as_of")
    both = lambda rows, held: _forever(later(rows).unionByName(held.withColumn("lost", F.lit(False))))
    hubs = _hubs(counts, marks)
    if hubs.isEmpty():
        return standing(both(moves(facts), held), marks)
    (few, many), (held, known) = _by(marks, hubs), _by(held, hubs)
    sums = cut(block_sums(facts).drop("n").join(hubs, KEY, "left_semi"))
    deltas = later(sums)
    placed = by_block(deltas, many.select(*KEY, "block", F.col("block").alias("mark")), KEY, "after", sums.select(*KEY, "block")).select(*KEY, "token_address", F.col("point.mark").alias("mark"), "delta").filter("mark is not null")
    first = many.groupBy(*KEY).agg(F.min("block").alias("mark"))
    start = known.join(first, KEY).select(*KEY, "token_address", "mark", u256.parse(F.col("amount")).alias("delta"))
    ran = rendered(running_sums(placed.unionByName(start), many.withColumnRenamed("block", "mark"), KEY), amount="balance")
    return standing(both(_by(moves(facts), hubs)[0], held), few).unionByName(ran)


def rebuild(transfers: DataFrame, to_block: int, taken: DataFrame, revision: int, from_block: int | None = None, events: int = EVENTS, blocks: int = BLOCKS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Snapshots and pointers of a new replay under a new revision, and how many old ones each account loses by it.

    ``from_block`` counts those from that block on, as a targeted rebuild reports it; without it all count. Either way
    the whole history is replayed.
    """
    made, pointer = start(transfers, to_block, revision, events, blocks)
    return made, pointer, lost(taken, from_block)


def lost(taken: DataFrame, from_block: int | None = None) -> DataFrame:
    """invalidated, how many snapshots each account loses to a rebuild."""
    gone = taken if from_block is None else taken.filter(F.col("block") >= from_block)
    return gone.select(*KEY, "block").distinct().groupBy(*KEY).agg(F.count("*").alias("invalidated"))


def readiness(probes: DataFrame, pointer: DataFrame) -> DataFrame:
    """state of (chain_id, address, at_block) probes: unavailable without a replay, building before it got there, or ready."""
    rows = probes.join(pointer.select(*KEY, "as_of", "revision"), KEY, "left")
    return rows.withColumn("state", F.when(F.col("as_of").isNull(), "unavailable").when(F.col("as_of") >= F.col("at_block"), "ready").otherwise("building"))


def invalidate(taken: DataFrame, from_block: int) -> tuple[DataFrame, DataFrame]:
    """Snapshots that stay, and the count of those from a block on that go."""
    return taken.filter(F.col("block") < from_block), taken.filter(F.col("block") >= from_block).agg(F.count("*").alias("invalidated"))


def drop_pointers(pointer: DataFrame, accounts: DataFrame) -> DataFrame:
    """Pointers without those of accounts whose snapshots were invalidated; their next replay starts anew."""
    return pointer.join(accounts.select(*KEY).distinct(), KEY, "left_anti")


def at_block(taken: DataFrame, transfers: DataFrame, probes: DataFrame) -> DataFrame:
    """State for (chain_id, address, at_block) probes: the newest snapshot at or before the block plus later deltas.

    Facts no later than the oldest snapshot that an account's probes start from, or after its last probe, are dropped
    before anything is summed.
    """
    asked = probes.select(*KEY, F.col("at_block").alias("block")).distinct()
    edges = taken.select(*KEY, "block", F.col("block").alias("snapshot")).distinct()
    near = cut(by_block(asked, edges, KEY, "before").select(*KEY, "block", F.coalesce("point.snapshot", F.lit(NEVER)).alias("since")))
    span = cut(near.groupBy(*KEY).agg(F.min("since").alias("__low"), F.max("block").alias("__high"), F.count("*").alias("__n")))
    near_facts = _within(transfers, span)
    counts = watched(near_facts.select("chain_id", "from_address", "to_address")).groupBy(*KEY).agg(F.count("*").alias("__facts"))
    hubs = cut(span.join(counts, KEY, "left").filter((F.col("__n") > FEW) | (F.col("__facts") > LARGE)).select(*KEY))
    if hubs.isEmpty():
        return _stood(taken, near_facts, near)
    few, many = _by(near, hubs)
    return _stood(taken, near_facts, few).unionByName(_looked_up(taken, near_facts, many, _by(span, hubs)[1].drop("__n")))


def _stood(taken: DataFrame, transfers: DataFrame, near: DataFrame) -> DataFrame:
    """at_block for accounts with few probes: each snapshot and the moves up to its last probe are a history of their own."""
    used = near.groupBy(*KEY, "since").agg((F.max("block") + 1).alias("until"))
    spans = used.select(*KEY, "since", "until")
    moved = moves(transfers).join(spans.hint("merge"), KEY).filter("block > since and block < until").drop("since")
    held = taken.withColumnRenamed("block", "since").join(used, [*KEY, "since"]).select(*KEY, "token_address", F.col("since").alias("block"), "amount", F.lit(False).alias("lost"), "until")
    return standing(moved.unionByName(held), near).withColumnRenamed("block", "at_block").select(*KEY, "token_address", "at_block", "amount")


def _looked_up(taken: DataFrame, transfers: DataFrame, near: DataFrame, span: DataFrame) -> DataFrame:
    """at_block by as-of lookups in buckets of blocks, for accounts with many probes or facts."""
    inside = block_deltas(transfers).join(span, KEY).filter("block > __low and block <= __high").drop("__low", "__high")
    marks = near.select(*KEY, "block", "since")
    # probes that start from one snapshot follow each other without another's in between
    placed = by_block(inside, marks, KEY, "after", touched_blocks(transfers)).filter("block > point.since").select(*KEY, F.col("point.since").alias("since"), "token_address", F.col("point.block").alias("mark"), "delta")
    moved = running_sums(placed, marks.withColumnRenamed("block", "mark"), [*KEY, "since"]).select(*KEY, "token_address", "block", F.col("balance").alias("x"))
    held = near.join(taken.withColumnRenamed("block", "since"), [*KEY, "since"]).select(*KEY, "token_address", "block", u256.parse(F.col("amount")).alias("x"))
    sums = held.unionByName(moved).groupBy(*KEY, "token_address", "block").agg(u256.sum_(F.col("x")).alias("balance"))
    return rendered(sums.withColumnRenamed("block", "at_block"), amount="balance")


def _within(transfers: DataFrame, span: DataFrame) -> DataFrame:
    """Transfers in the blocks of some account's span, for pruning before they are summed."""
    bounds = span.groupBy("chain_id").agg(F.min("__low").alias("__first"), F.max("__high").alias("__last"))
    return transfers.join(F.broadcast(bounds), "chain_id").filter("block > __first and block <= __last").drop("__first", "__last")
