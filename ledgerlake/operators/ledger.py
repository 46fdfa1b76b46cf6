"""Replay of facts into exact balances (survey 2.5, 2.6, 2.7, 2.10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlake.functions import u256
from ledgerlake.functions.scalars import call_argument, canonical_decimal, selector
from ledgerlake.operators.asof import as_of
from ledgerlake.operators.identity import is_valued

ZERO = "0x" + "0" * 40
# The wrapped native token of each chain.
WRAPPED_NATIVE = {
    1: "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2",
    8453: "0x4200000000000000000000000000000000000006",
    10: "0x4200000000000000000000000000000000000006",
    42161: "0x82af49447d8a07e3bd95bd0d56f35241523fbab1",
    137: "0x7ceb23fd6bc0add59e62ac25578270cff1b9f619",
    56: "0xbb4cdb9cbd36b01bd1cbaebf2de08d9173bc095c",
}
DEPOSIT, WITHDRAW = "d0e30db0", "2e1a7d4d"


def amount_limbs(c: str) -> Column:
    return u256.parse(F.col(c))


def watched(transfers: DataFrame) -> DataFrame:
    """A row for each account that a transfer touches, once for a transfer to oneself; column address."""
    sides = F.array_distinct(F.array("from_address", "to_address"))
    return transfers.drop("address").withColumn("address", F.explode(sides))


def entries(transfers: DataFrame, *more: str) -> DataFrame:
    """Two rows for each transfer, what ``to_address`` gained and what ``from_address`` lost, as limbs."""
    zero = u256.limbs(*[F.lit(0)] * 3)
    amount = amount_limbs("amount")
    sides = F.array(F.struct(F.col("to_address").alias("address"), F.col("x").alias("gained"), zero.alias("lost")), F.struct(F.col("from_address").alias("address"), zero.alias("gained"), F.col("x").alias("lost")))
    rows = transfers.select("chain_id", "token_address", *more, "from_address", "to_address", amount.alias("x"))
    return rows.select("chain_id", "token_address", *more, F.explode(sides).alias("e")).select("chain_id", "e.address", "token_address", *more, "e.gained", "e.lost").filter("address is not null")


#: Marks of an account up to which its moves are joined to all of them.
FEW = 128

#: Bits of a sieve of keys, and rows of it that are broadcast at most.
SIEVE = 1 << 20


def sieved(rows: DataFrame, few: DataFrame, key: list[str]) -> DataFrame:
    """Those of rows whose key may be among the keys of ``few``: a Bloom filter of one hash, before a join that would shuffle all.

    The hashes of the few keys, SIEVE at most whatever their number, are broadcast, so that the bulk of rows is dropped where it is read.
    """
    bit = F.pmod(F.xxhash64(*key), F.lit(SIEVE)).cast("int")
    bits = few.select(bit.alias("__bit")).distinct()
    return rows.withColumn("__bit", bit).join(F.broadcast(bits), "__bit", "left_semi").drop("__bit")


def settlements(transfers: DataFrame) -> DataFrame:
    """settled limbs of each account and token: mints in a transaction in which the account also sends that token.

    Only mints are joined, to what accounts send; sends that cannot be a mint's are dropped before they shuffle.
    """
    key = ["chain_id", "address", "tx_hash", "token_address"]
    mints = transfers.filter(F.col("from_address") == ZERO).select("chain_id", F.col("to_address").alias("address"), "tx_hash", "token_address", "amount")
    sends = transfers.select("chain_id", F.col("from_address").alias("address"), "tx_hash", "token_address")
    return mints.join(sieved(sends, mints, key), key, "left_semi").groupBy("chain_id", "address", "token_address").agg(u256.sum_(amount_limbs("amount")).alias("settled"))


#: Facts of a task that sums them before they shuffle.
TASK_FACTS = 1_000_000


def dealt(facts: DataFrame) -> DataFrame:
    """Stored facts in as many tasks as their number asks for, so that what a task sums does not grow with the table."""
    n = -(-facts.count() // TASK_FACTS)
    return facts if n <= facts.rdd.getNumPartitions() else facts.repartition(n, *facts.columns)


def sum_balances(transfers: DataFrame) -> DataFrame:
    """balance, incoming and outgoing limbs of every account and token; legs are summed in each task before they shuffle."""
    key = ["chain_id", "address", "token_address"]
    wide = F.coalesce(F.col("amount").rlike("^-?[0-9]{19,78}$"), F.lit(False))
    legs = moves(transfers.withColumn("block", F.lit(0)))

    def summed(rows: DataFrame, names: tuple[str, ...], gained: str, lost: str) -> DataFrame:
        rows = u256.in_nines(rows, "amount", F.lit(False))
        sides = [(F.sum(F.when(of, F.col(n)).otherwise(0)), f"{s}{n}") for s, of in (("g", ~F.col("lost")), ("l", F.col("lost"))) for n in names]
        sums = rows.groupBy(*key).agg(*[x.alias(n) for x, n in sides])
        side = lambda s: u256.of_nines({n: F.col(f"{s}{n}") for n in names})
        return sums.select(*key, side("g").alias(gained), side("l").alias(lost))

    # amounts of up to 18 digits, nearly all, are sums of two longs a side; longer ones are added to these
    short = summed(legs.withColumn("amount", F.when(~wide, F.col("amount"))), u256.NINES[:2], "g", "l")
    both = short.join(summed(legs.filter(wide), u256.NINES, "__g", "__l"), key, "left").join(settlements(transfers), key, "left")
    zero = lambda c: u256.limbs(*[F.coalesce(F.col(c)[p], F.lit(0)) for p in u256.PARTS])
    both = both.select(*key, u256.plus(F.col("g"), zero("__g")).alias("g"), u256.plus(F.col("l"), zero("__l")).alias("l"), zero("settled").alias("s"))
    return both.select(*key, u256.minus(F.col("g"), F.col("l")).alias("balance"), u256.minus(F.col("g"), F.col("s")).alias("incoming"), F.col("l").alias("outgoing"))


def rendered(sums: DataFrame, **columns: str) -> DataFrame:
    """The limb columns named by ``columns`` (new name = limb column) as decimal strings, beside all others."""
    keep = [c for c in sums.columns if c not in set(columns.values())]
    return sums.select(*keep, *[u256.render(F.col(c)).alias(n) for n, c in columns.items()])


def token_balances(transfers: DataFrame, to_block: int | None = None, tokens: list[str] | None = None) -> DataFrame:
    """Exact balance of every account and token as of a block: chain_id, address, token_address, amount, incoming, outgoing."""
    facts = transfers if to_block is None else transfers.filter(F.col("block") <= to_block)
    if tokens is not None:
        facts = facts.filter(F.col("token_address").isin(tokens))
    return rendered(sum_balances(facts), amount="balance", incoming="incoming", outgoing="outgoing")


def simple_balances(transfers: DataFrame, to_block: int | None = None) -> DataFrame:
    """The same without interest settlement: one shuffle, on the account and token, after map-side sums."""
    facts = transfers if to_block is None else transfers.filter(F.col("block") <= to_block)
    sums = entries(facts).groupBy("chain_id", "address", "token_address").agg(u256.sum_(F.col("gained")).alias("g"), u256.sum_(F.col("lost")).alias("l"))
    return rendered(sums.select("chain_id", "address", "token_address", u256.minus(F.col("g"), F.col("l")).alias("balance")), amount="balance")


def negative_warnings(balances: DataFrame) -> DataFrame:
    """warnings, the sorted negative_balance:<token> of each account that has some."""
    bad = balances.filter(F.col("amount").startswith("-"))
    return bad.groupBy("chain_id", "address").agg(F.array_sort(F.collect_list(F.concat(F.lit("negative_balance:"), "token_address"))).alias("warnings"))


def account_legs(rows: DataFrame) -> DataFrame:
    """Transactions or internal legs, once for each account they touch."""
    return watched(rows.filter("from_address is not null or to_address is not null")).filter("address is not null")


def native_flows(transactions: DataFrame, internals: DataFrame, exclude_reverted: bool = False) -> DataFrame:
    """native_in, native_out and transaction_count of each account, internal legs matched off first.

    Legs are counted by (chain, tx, from, to, value) before they are dealt to their accounts: of n internal legs, as
    many as there are transaction legs go, as :func:`drop_matched_internals` says; which ones does not matter here.
    """
    if exclude_reverted:
        transactions = transactions.filter("status <> 'reverted'")
    key = ["chain_id", "tx_hash", "from_address", "to_address", "value"]
    legs = lambda rows, t: rows.select("chain_id", "tx_hash", "from_address", "to_address", canonical_decimal(F.col("value")).alias("value"), F.lit(t).alias("t"), F.lit(1 - t).alias("i"))
    counts = legs(transactions, 1).unionByName(legs(internals, 0)).groupBy(*key).agg(F.sum("t").alias("t"), F.sum("i").alias("i"))
    extra = F.when(is_valued(F.col("value")), F.greatest(F.col("i") - F.col("t"), F.lit(0))).otherwise(F.col("i"))
    sides = account_legs(counts.withColumn("legs", F.col("t") + extra))
    value = amount_limbs("value")
    times = u256.limbs(*[(value[p] * F.col("legs")).cast(u256.LIMB) for p in u256.PARTS])
    sums = sides.filter("legs > 0").groupBy("chain_id", "address").agg(
        u256.sum_(u256.where(F.col("to_address") == F.col("address"), times)).alias("i"),
        u256.sum_(u256.where(F.col("from_address") == F.col("address"), times)).alias("o"),
        F.sum("t").cast("bigint").alias("transaction_count"),
    )
    return rendered(sums, native_in="i", native_out="o")


def wrapped_native(transactions: DataFrame, transfers: DataFrame, wrapped: dict[int, str] = WRAPPED_NATIVE) -> DataFrame:
    """Transfers for wrapping and unwrapping of the native token that the transfers lack.

    A deposit is a positive value sent to the wrapper with the deposit selector or no input; a withdrawal carries its
    amount as argument. Both are left out where a canonical transfer of that side exists: an anti join on (chain, tx),
    for which only transfers that may match are shuffled.
    """
    token = F.create_map(*[F.lit(x) for kv in wrapped.items() for x in kv])
    rows = transactions.withColumn("token_address", F.try_element_at(token, F.col("chain_id").cast("int"))).filter(F.col("to_address") == F.col("token_address"))
    bare = F.coalesce(F.col("input"), F.lit("")).isin("", "0x") | (selector(F.col("input")) == DEPOSIT)
    base = ["chain_id", "tx_hash", "block", "token_address"]
    deposits = rows.filter(bare & u256.is_positive(amount_limbs("value"))).select(*base, F.lit(ZERO).alias("from_address"), F.col("from_address").alias("to_address"), F.col("value").alias("amount"), F.lit("deposit").alias("source"))
    taken = u256.hex_text(call_argument(F.col("input")))
    withdrawals = rows.filter(selector(F.col("input")) == WITHDRAW).select(*base, F.col("from_address"), F.lit(ZERO).alias("to_address"), taken.alias("amount"), F.lit("withdrawal").alias("source")).filter("amount <> '0'")
    there = transfers.select("chain_id", "tx_hash", "token_address", "from_address", "to_address")
    lacking = lambda rows, key: rows.join(sieved(there.select(*key), rows, key), key, "left_anti").select(*base, "from_address", "to_address", "amount", "source")
    side = ["chain_id", "tx_hash", "token_address"]
    return lacking(deposits, [*side, "to_address"]).unionByName(lacking(withdrawals, [*side, "from_address"]))


def ledger(transfers: DataFrame, transactions: DataFrame, internals: DataFrame) -> DataFrame:
    """One stream of facts with their kind."""
    parts = [d.withColumn("kind", F.lit(k)) for d, k in ((transfers, "erc20"), (transactions, "tx"), (internals, "internal"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def block_sums(transfers: DataFrame) -> DataFrame:
    """delta limbs of each account, token and block in which something moved, and n, its facts; one of an account to itself counts once."""
    own = transfers.withColumn("__own", F.coalesce(F.col("from_address") == F.col("to_address"), F.lit(False)))
    sums = entries(own, "block", "__own").groupBy("chain_id", "address", "token_address", "block").agg(u256.sum_(F.col("gained")).alias("g"), u256.sum_(F.col("lost")).alias("l"), F.sum(F.when(F.col("__own"), 1).otherwise(2)).alias("n"))
    return sums.select("chain_id", "address", "token_address", "block", u256.minus(F.col("g"), F.col("l")).alias("delta"), F.floor(F.col("n") / 2).cast("bigint").alias("n"))


def block_deltas(transfers: DataFrame) -> DataFrame:
    """delta limbs of each account, token and block in which something moved."""
    return block_sums(transfers).drop("n")


def balance_history(transfers: DataFrame) -> DataFrame:
    """Balance after each block in which it changed or moved: chain_id, address, token_address, block, amount.

    Facts are summed by block first, so the running window sees one row for each block.
    """
    key = ["chain_id", "address", "token_address"]
    run = Window.partitionBy(*key).orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    rows = u256.in_nines(moves(transfers), "amount", F.col("lost")).groupBy(*key, "block").agg(*[F.sum(n).alias(n) for n in u256.NINES])
    return rows.select(*key, "block", *[F.sum(n).over(run).alias(n) for n in u256.NINES]).select(*key, "block", u256.nines_text().alias("amount"))


def moves(transfers: DataFrame) -> DataFrame:
    """chain_id, address, token_address, block, amount and lost: both sides of each transfer, amounts as they are."""
    side = lambda c, lost: F.struct(F.col(c).alias("address"), F.lit(lost).alias("lost"))
    rows = transfers.select("chain_id", "token_address", "block", "amount", F.explode(F.array(side("to_address", False), side("from_address", True))).alias("e"))
    return rows.select("chain_id", "e.address", "token_address", "block", "amount", "e.lost").filter("address is not null")


def standing(moved: DataFrame, marks: DataFrame) -> DataFrame:
    """chain_id, address, token_address, block and amount of each token moved by then, at each mark of an account.

    moved: rows as of :func:`moves`, and until, the block from which a row says no more (null: never), by which the
    rows of one account fall into histories of their own. marks: chain_id, address, block. All steps are by account, so
    that moves shuffle once and are sorted once: a running sum by token holds from its block to the next one, and is
    joined to the marks between. Meant for accounts with few marks (:data:`FEW`).
    """
    # address first: a sort tells most rows apart by the beginning of its first column
    key = ["address", "chain_id"]
    ordered = moved.select(*key, "token_address", "until", "block", "amount", "lost").repartition(*key).sortWithinPartitions(*key, "token_address", "until", "block")
    rows = u256.in_nines(ordered, "amount", F.col("lost")).drop("lost")
    by = Window.partitionBy(*key, "token_address", "until").orderBy("block")
    run = by.rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.select(*key, "token_address", "block", F.coalesce(F.lead("block").over(by), "until").alias("__next"), *[F.sum(n).over(run).alias(n) for n in u256.NINES]).filter("__next is null or __next > block")
    at = marks.select(*key, F.col("block").alias("__mark"))
    held = sums.join(at.hint("merge"), key).filter("__mark >= block and (__next is null or __mark < __next)")
    return held.select("chain_id", "address", "token_address", F.col("__mark").alias("block"), u256.nines_text().alias("amount"))


def by_block(rows: DataFrame, marks: DataFrame, key: list[str], mode: str, places: DataFrame | None = None) -> DataFrame:
    """As-of lookup by block number, in buckets of 10,000 blocks."""
    return as_of(rows, marks, key, mode, at="block", position=F.col("block").cast("bigint"), width=10_000, unit=1, places=places)


def touched_blocks(transfers: DataFrame) -> DataFrame:
    """chain_id, address and block of everything that transfers move, told without their amounts."""
    sides = transfers.select("chain_id", "block", F.explode(F.array("from_address", "to_address")).alias("address"))
    return sides.filter("address is not null")


def at_marks(transfers: DataFrame, marks: DataFrame) -> DataFrame:
    """Balances at each mark (chain_id, address, block) of an account's history; deltas after the last mark of a chain are left out."""
    mine = transfers.join(F.broadcast(marks.groupBy("chain_id").agg(F.max("block").alias("__last"))), "chain_id").filter("block <= __last").drop("__last")
    return sums_at(block_deltas(mine), marks, touched_blocks(mine))


def sums_at(deltas: DataFrame, marks: DataFrame, places: DataFrame) -> DataFrame:
    """The same from deltas of :func:`block_deltas`; places: chain_id, address and block of them, others too.

    A delta belongs to the first mark at or after its block, by an as-of lookup in buckets of blocks, so that a hub
    account's history is many tasks.
    """
    key = ["chain_id", "address"]
    points = marks.select(*key, "block", F.col("block").alias("mark")).distinct()
    placed = by_block(deltas, points, key, "after", places).select(*key, "token_address", F.col("point.mark").alias("mark"), "delta").filter("mark is not null")
    return running_sums(placed, points.select(*key, "mark"), key)


def running_sums(placed: DataFrame, marks: DataFrame, key: list[str]) -> DataFrame:
    """key, token_address, block and balance limbs at each mark: sums by mark, then a running sum over a key's marks.

    placed: key, token_address, mark, delta. A token is there from the mark on by which it first moved. The running sum
    sees a row for each mark and token.
    """
    parts = placed.groupBy(*key, "token_address", "mark").agg(u256.sum_(F.col("delta")).alias("part"))
    since = parts.groupBy(*key, "token_address").agg(F.min("mark").alias("__since"))
    grid = since.join(marks.select(*key, "mark"), key).filter("mark >= __since").drop("__since")
    filled = grid.join(parts, [*key, "token_address", "mark"], "left")
    run = Window.partitionBy(*key, "token_address").orderBy("mark").rowsBetween(Window.unboundedPreceding, 0)
    sums = filled.select(*key, "token_address", "mark", *[F.sum(F.coalesce(F.col("part")[p], F.lit(0).cast(u256.LIMB))).over(run).alias(p) for p in u256.PARTS])
    return sums.select(*key, "token_address", F.col("mark").alias("block"), u256.limbs(*[F.col(p) for p in u256.PARTS]).alias("balance"))


def state_at(transfers: DataFrame, probes: DataFrame) -> DataFrame:
    """Balances for (chain_id, address, at_block) probes: all tokens moved by then, summed up to the block.

    The probes of an account are marks in its history: each delta is met once, however many probes there are.
    """
    asked = probes.select("chain_id", "address", F.col("at_block").alias("block")).distinct()
    return rendered(at_marks(transfers, asked).withColumnRenamed("block", "at_block"), amount="balance")
