"""Filters, orders, pages and checks over fact tables (survey 2.3, 2.8, 2.9, A6-A11, W1, W6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlake.lineage import stored
from ledgerlake.operators import identity
from ledgerlake.operators.ledger import sieved

#: Blocks of a scope whose counts one task sums, and rows for which there is one task more.
SPAN, TASK_ROWS = 10_000, 100_000


def parts(rows: int) -> int:
    """Tasks for so many rows, so that the memory of one stays the same whatever the tables' size."""
    return max(1, -(-rows // TASK_ROWS))


def in_blocks(facts: DataFrame, first: int, last: int) -> DataFrame:
    return facts.filter(F.col("block").between(first, last))


def for_accounts(facts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Facts of a set of accounts: a semi join on (chain_id, address), for which only facts that may match are shuffled."""
    few = accounts.select("chain_id", "address").distinct()
    return sieved(facts, few, few.columns).join(few, few.columns, "left_semi")


def for_tokens(facts: DataFrame, tokens: list[str]) -> DataFrame:
    return facts.filter(F.col("token_address").isin([t.lower() for t in tokens]))


def direction() -> Column:
    """incoming or outgoing; a transfer to oneself reads incoming."""
    return F.when(F.col("to_address") == F.col("address"), "incoming").otherwise("outgoing")


def in_direction(facts: DataFrame, which: str) -> DataFrame:
    if which == "both":
        return facts
    return facts.filter(F.col("to_address" if which == "incoming" else "from_address") == F.col("address"))


def merged_directions(incoming: DataFrame, outgoing: DataFrame) -> DataFrame:
    """Both streams; a transfer to oneself stays in the outgoing one only."""
    return incoming.filter(F.col("from_address") != F.col("address")).unionByName(outgoing)


def involving(rows: DataFrame, accounts: DataFrame) -> DataFrame:
    """Internal transfers from or to an account of the set, once for each such account."""
    side = lambda c: rows.withColumn("address", F.col(c))
    return for_accounts(side("from_address").unionByName(side("to_address").filter("from_address <> to_address")), accounts)


def deployed(requests: DataFrame) -> DataFrame:
    """code NOT_DEPLOYED_AT_BLOCK where a request's block is before its contract's."""
    return requests.withColumn("code", F.when(F.col("block") < F.col("deployment_block"), "NOT_DEPLOYED_AT_BLOCK"))


def non_zero(holdings: DataFrame) -> DataFrame:
    return holdings.filter(~F.col("amount").rlike("^0*$"))


def on_networks(rows: DataFrame, networks: list[str]) -> DataFrame:
    return rows.filter(F.col("network").isin(networks))


def out_of_place(rows: DataFrame, chain_id: int, provider: str, first: int, last: int) -> DataFrame:
    """Rows of another chain, provider or block range than asked for, with the reason."""
    why = F.when(F.col("chain_id") != chain_id, "CHAIN").when(F.col("provider") != provider, "PROVIDER").when(~F.col("block").between(first, last), "RANGE")
    return rows.withColumn("reason", why).filter("reason is not null")


def checked(rows: DataFrame, violations: DataFrame) -> DataFrame:
    """rows, or an error if there are violations: nothing passes in part."""
    bad = violations.limit(1).collect()
    if bad:
        raise ValueError(f"constraint broken, for example by {bad[0].asDict()}")
    return rows


def fact_order() -> list[Column]:
    return [F.col("block").asc(), F.col("tx_hash").asc(), F.col("log_index").asc(), F.col("identity").asc()]


def scan_order() -> list[Column]:
    return [F.col("block").asc(), F.col("transaction_index").asc_nulls_last(), F.col("log_index").asc_nulls_last(), F.col("tx_hash").asc(), F.col("identity").asc()]


def transaction_order(descending: bool = False) -> list[Column]:
    if descending:
        return [F.col("block").desc(), F.col("transaction_index").desc_nulls_first(), F.col("tx_hash").desc()]
    return [F.col("block").asc(), F.col("transaction_index").asc_nulls_last(), F.col("tx_hash").asc()]


def page(rows: DataFrame, order: list[str], after: tuple | None = None, limit: int = 100) -> DataFrame:
    """The next ``limit`` rows after a cursor of values of ``order``, and has_next; a top-k, not a full sort."""
    if after is not None:
        later = F.lit(False)
        for k in range(len(order)):
            same = F.lit(True)
            for c, v in zip(order[:k], after[:k], strict=True):
                same = same & (F.col(c) == v)
            later = later | (same & (F.col(order[k]) > after[k]))
        rows = rows.filter(later)
    top = rows.orderBy(*order).limit(limit + 1)
    ranked = top.withColumn("__n", F.row_number().over(Window.orderBy(*order))).withColumn("has_next", F.count("*").over(Window.partitionBy()) > limit)
    return ranked.filter(F.col("__n") <= limit).drop("__n")


def within_limit(rows: DataFrame, most: int) -> DataFrame:
    if rows.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} records")
    return rows


def duplicate_count(facts: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """kind and duplicates, the rows beyond the first of each key, by kind."""
    parts = None
    for kind, key in keys.items():
        d = facts.filter(F.col("kind") == kind).groupBy(*key).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates")).select(F.lit(kind).alias("kind"), "duplicates")
        parts = d if parts is None else parts.unionByName(d)
    return parts


def gaps(facts: DataFrame, scope: list[str], first: int | None = None, last: int | None = None, most: int | None = 50) -> DataFrame:
    """from_block and to_block of each hole between consecutive blocks with facts, the first ``most`` of each scope."""
    if first is not None:
        facts = in_blocks(facts, first, last)
    order = Window.partitionBy(*scope).orderBy("block")
    rows = facts.select(*scope, "block").distinct().withColumn("before", F.lag("block").over(order)).filter("block > before + 1")
    rows = rows.select(*scope, (F.col("before") + 1).alias("from_block"), (F.col("block") - 1).alias("to_block"))
    if most is None:
        return rows
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*scope).orderBy("from_block"))).filter(F.col("__n") <= most).drop("__n")


def tiles(ranges: DataFrame, size: int) -> DataFrame:
    """Ranges (scope columns, first, last) cut into windows of at most ``size`` blocks."""
    scope = [c for c in ranges.columns if c not in ("first", "last")]
    rows = ranges.select(*scope, "last", F.explode(F.sequence("first", "last", F.lit(size).cast("bigint"))).alias("start"))
    return rows.select(*scope, "start", F.least(F.col("start") + size - 1, F.col("last")).alias("end"))


def halved(facts: DataFrame, ranges: DataFrame, most: int) -> DataFrame:
    """Ranges halved until each window holds at most ``most`` facts: scope columns, start, end, records and over.

    ranges: scope columns, first, last, any number for a scope; facts: the same scope columns and block. A window of more
    facts is cut in two, the first half one block longer where its length is odd. A single block of more facts stays, and is told by
    ``over``. The windows of a range cover it exactly; a range of which first is after last has none.

    All scopes at once: each block's count goes to every window above it in the tree of halves, by the half that holds the
    block, so that a window's sum tells both of its halves and no window is looked up again. Counts are summed for SPAN blocks
    of a scope first, so a scope with very many facts is not one task; tasks grow in number with the counts.
    """
    scope = [c for c in ranges.columns if c not in ("first", "last")]
    asked = ranges.filter("first <= last").distinct().withColumns({c: F.col(c).cast("bigint") for c in ("first", "last")})
    counts = stored(facts.groupBy(*scope, "block").agg(F.count("*").alias("n")))
    tasks = parts(counts.count())
    inside = counts.join(asked, scope).filter("block between first and last").withColumn("__span", F.floor(F.col("block") / SPAN)).repartition(tasks, *scope, "__span")
    window = lambda lo, hi: F.struct(lo.alias("lo"), hi.alias("hi"))
    half = lambda w: w["lo"] + F.floor((w["hi"] - w["lo"]) / 2).cast("bigint")

    def below(path: Column) -> Column:
        """The path from the whole range with the half of its last window that holds the block, while that can be halved itself."""
        w = F.element_at(path, -1)
        left = F.col("block") <= half(w)
        inner = window(F.when(left, w["lo"]).otherwise(half(w) + 1), F.when(left, half(w)).otherwise(w["hi"]))
        return F.when(inner["lo"] < inner["hi"], F.concat(path, F.array(inner))).otherwise(path)

    depth = F.ceil(F.log2((F.col("last") - F.col("first") + 1).cast("double"))).cast("int") + 1  # one more than doubles may round off
    path = F.aggregate(F.sequence(F.lit(1), depth), F.array(window(F.col("first"), F.col("last"))), lambda done, _: below(done))
    key = [*scope, "first", "last"]
    node = [*key, "lo", "hi"]
    mid = F.col("lo") + F.floor((F.col("hi") - F.col("lo")) / 2).cast("bigint")
    met = inside.select(*key, "__span", "block", "n", F.explode(F.array_distinct(path)).alias("w")).select(*key, "__span", "block", "n", "w.lo", "w.hi")
    some = met.groupBy(*scope, "__span", "first", "last", "lo", "hi").agg(*[F.sum(F.when(x, F.col("n")).otherwise(0)).alias(c) for c, x in (("l", F.col("block") <= mid), ("r", F.col("block") > mid))])
    none = asked.select(*key, F.col("first").alias("lo"), F.col("last").alias("hi"), F.lit(0).cast("bigint").alias("l"), F.lit(0).cast("bigint").alias("r"))
    sums = some.drop("__span").unionByName(none).repartition(tasks, *node).groupBy(*node).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    piece = lambda lo, hi, n: F.struct(lo.alias("start"), hi.alias("end"), n.alias("records"))
    n, single = F.col("l") + F.col("r"), F.col("lo") == F.col("hi")
    whole = F.when((F.col("lo") == F.col("first")) & (F.col("hi") == F.col("last")) & ((n <= most) | single), F.array(piece(F.col("lo"), F.col("hi"), n)))
    halves = F.when((n > most) & ~single, F.filter(F.array(piece(F.col("lo"), mid, F.col("l")), piece(mid + 1, F.col("hi"), F.col("r"))), lambda p: (p["records"] <= most) | (p["start"] == p["end"])))
    return sums.select(*key, F.explode(F.coalesce(whole, halves)).alias("w")).select(*key, "w.*", (F.col("w.records") > most).alias("over")).repartition(tasks, *scope)


def exact_cover(windows: DataFrame, scope: list[str], first: str, last: str) -> DataFrame:
    """Scopes whose windows (start, end) are not contiguous, disjoint and exactly [first, last]."""
    order = Window.partitionBy(*scope).orderBy("start")
    joined = windows.withColumn("next", F.lead("start").over(order))
    broken = F.max((F.col("next") != F.col("end") + 1).cast("int"))
    sums = joined.groupBy(*scope).agg(F.coalesce(broken, F.lit(0)).alias("broken"), F.min("start").alias("lo"), F.max("end").alias("hi"), F.max(first).alias("__first"), F.max(last).alias("__last"))
    return sums.filter("broken = 1 or lo <> __first or hi <> __last").select(*scope)


def by_hashes(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """Rows, such as transaction contexts, of a set of transactions (tx_hash), however large: a semi join."""
    asked = identity.distinct_requests(hashes.select("tx_hash"), "tx_hash")
    return rows.join(asked, "tx_hash", "left_semi")


def closed_range(kind: str, rows: DataFrame, accounts: DataFrame, chain_id: int, provider: str, first: int, last: int, order: list[str]) -> DataFrame:
    """All facts of one kind of a set of accounts in [first, last]: checked, each once, in order.

    kind: transfers, transactions, internals or withdrawals. A row of another chain, provider or range fails the whole
    read. Of equal facts (by stable identity, hash, composite key, or withdrawal index) the first by ``order`` stays;
    transfers and transactions carry an ``address``, internals belong to the accounts on either side.
    """
    rows = checked(rows, out_of_place(rows, chain_id, provider, first, last))
    if kind == "transfers":
        return identity.stable_dedup(for_accounts(rows, accounts), order).orderBy(*scan_order())
    if kind == "transactions":
        return identity.first_wins(for_accounts(rows, accounts), ["chain_id", "address", "tx_hash"], order).orderBy(*transaction_order())
    if kind == "internals":
        # both sides are in the key, so that rows of other accounts need no dedup
        return identity.first_wins(involving(rows.drop("address"), accounts), ["chain_id", "address", *identity.INTERNAL_KEY], order).orderBy("block", "tx_hash", "trace_id", "address")
    if kind == "withdrawals":
        return identity.dedup_withdrawals(for_accounts(rows, accounts), order).orderBy("block", "withdrawal_index")
    raise ValueError(f"no such kind: {kind}")


def scan_stats(windows: DataFrame, removed: DataFrame) -> DataFrame:
    """windows, duplicates_removed and windows_by_provider of a scan."""
    by = windows.groupBy("provider").agg(F.count("*").alias("n"))
    stats = by.agg(F.sum("n").alias("windows"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("provider", "n")))).alias("windows_by_provider"))
    return stats.crossJoin(removed.select(F.col("removed").alias("duplicates_removed")))
