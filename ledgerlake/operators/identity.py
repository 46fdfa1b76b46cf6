"""Identity and de-duplication of facts (survey 2.4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlake.functions.scalars import canonical_decimal, field_hash, nullable_lower

TRANSFER_FIELDS = ("block_number", "from_address", "to_address", "amount")
INTERNAL_KEY = ("tx_hash", "trace_id", "from_address", "to_address", "value", "block_number")
TRANSFER_KEY = ("tx_hash", "log_index", "token_address", "from_address", "to_address", "amount")


def transfer_identity() -> Column:
    """chain:tx:log:token, or chain:tx:hash:<digest of the fields> where the log index is unknown."""
    digest = field_hash(*[F.col(c) for c in ("tx_hash", "token_address", *TRANSFER_FIELDS)])
    return F.when(F.col("log_index").isNotNull(), F.concat_ws(":", "chain_id", "tx_hash", "log_index", "token_address")).otherwise(F.concat_ws(":", "chain_id", "tx_hash", F.lit("hash"), digest))


def internal_identity() -> Column:
    digest = field_hash(*[F.col(c) for c in ("tx_hash", "block_number", "from_address", "to_address", "value")])
    return F.concat_ws(":", "chain_id", "tx_hash", F.coalesce("trace_id", digest))


def transaction_identity() -> Column:
    return F.concat_ws(":", "chain_id", "tx_hash")


def with_occurrences(transfers: DataFrame, order: list[Column]) -> DataFrame:
    """identity of each transfer; equal ones without a log index are numbered by ``order`` within their account.

    Only rows without a log index pass the window; those are few, and keyed by transaction.
    """
    based = transfers.withColumn("identity", transfer_identity())
    bare = based.filter("log_index is null")
    same = Window.partitionBy("chain_id", "address", "identity").orderBy(*order)
    numbered = bare.withColumn("__n", F.row_number().over(same) - 1)
    numbered = numbered.withColumn("identity", F.when(F.col("__n") > 0, F.concat("identity", F.lit(":occurrence:"), F.col("__n"))).otherwise(F.col("identity"))).drop("__n")
    return based.filter("log_index is not null").unionByName(numbered)


def first_wins(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row for each key, the first by ``order``: a partial minimum, so no group is gathered."""
    rest = [c for c in rows.columns if c not in {*key, *order}]
    best = rows.groupBy(*key).agg(F.min(F.struct(*order, *rest)).alias("__row"))
    return best.select(*key, *[F.col(f"__row.`{c}`").alias(c) for c in (*order, *rest)]).select(*rows.columns)


def last_wins(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in {*key, *order}]
    best = rows.groupBy(*key).agg(F.max(F.struct(*order, *rest)).alias("__row"))
    return best.select(*key, *[F.col(f"__row.`{c}`").alias(c) for c in (*order, *rest)]).select(*rows.columns)


def stable_dedup(rows: DataFrame, order: list[str], declared_unique: bool = False) -> DataFrame:
    """First of each log index, or source id, of a transaction; a row with neither fails unless the source is declared unique."""
    key = F.coalesce(F.concat(F.lit("log:"), F.col("log_index").cast("string")), F.concat(F.lit("id:"), F.col("source_id")))
    if declared_unique:
        key = F.coalesce(key, F.concat(F.lit("row:"), F.concat_ws(":", *order)))
    else:
        key = F.coalesce(key, F.raise_error(F.lit("a record has neither log index nor source id")).cast("string"))
    return first_wins(rows.withColumn("__key", key), ["chain_id", "address", "tx_hash", "__key"], order).drop("__key")


def dedup_internals(rows: DataFrame, order: list[str]) -> DataFrame:
    """First of the internal transfers that agree in transaction, trace, sides, value and block; missing values are equal."""
    return first_wins(rows, ["chain_id", *INTERNAL_KEY], order)


def dedup_transfers(rows: DataFrame, order: list[str]) -> DataFrame:
    """First of the transfers that agree in transaction, log index, token, sides and amount; missing values are equal."""
    return first_wins(rows, ["chain_id", *TRANSFER_KEY], order)


def dedup_withdrawals(rows: DataFrame, order: list[str]) -> DataFrame:
    """First of each withdrawal index."""
    return first_wins(rows, ["chain_id", "withdrawal_index"], order)


def distinct_requests(requests: DataFrame, column: str) -> DataFrame:
    """Hashes, tokens or addresses asked for, each once, in lower case; blank ones ask for nothing."""
    low = nullable_lower(F.col(column))
    return requests.withColumn(column, low).filter(F.col(column).isNotNull()).distinct()


def removed_count(rows: DataFrame, key: list[str]) -> DataFrame:
    """kept and removed, the counts of a dedup by key."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).agg(F.count("*").alias("kept"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("removed"))


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count; empty if the rows keep the constraint."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def is_valued(value: Column) -> Column:
    """Whether a text is a positive whole number."""
    return F.coalesce(value.rlike("^0*[1-9][0-9]*$"), F.lit(False))


def drop_matched_internals(transactions: DataFrame, internals: DataFrame) -> DataFrame:
    """Internal legs that no transaction leg accounts for.

    For each (chain, account, tx, from, to, value) with a positive value, as many internal legs go, first by identity,
    as there are transaction legs. A missing side, as in a contract's creation, equals a missing or empty one; values
    are equal as numbers. Legs whose value is zero or no number stay. One shuffle of each side on that key.
    """
    key = ["__chain", "__account", "__tx", "__from", "__to", "__value"]
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    keyed = lambda rows: rows.filter(is_valued(F.col("value"))).withColumns({"__chain": F.col("chain_id"), "__account": blank("address"), "__tx": F.col("tx_hash"), "__from": blank("from_address"), "__to": blank("to_address"), "__value": canonical_decimal(F.col("value"))})
    counted = keyed(transactions).groupBy(*key).agg(F.count("*").alias("__legs"))
    ranked = keyed(internals).withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy("identity")))
    left = ranked.join(counted, key, "left").filter(F.col("__n") > F.coalesce("__legs", F.lit(0))).select(*internals.columns)
    return left.unionByName(internals.filter(~is_valued(F.col("value"))))
