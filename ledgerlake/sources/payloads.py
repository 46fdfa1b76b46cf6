"""Landed provider payloads as normalised fact rows (survey 2.1)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import scalars as s

# What an explorer says where there is nothing, by kind; kinds not named here go by "transfers".
NOTHING = {"transactions": "no transactions? found", "transfers": "no (transactions|token transfers|transfers|records) found"}
TEXT = lambda *names: "struct<" + ",".join(f"{n}:string" for n in names) + ">"
EXPLORER = {
    "transactions": TEXT("blockNumber", "timeStamp", "hash", "nonce", "blockHash", "transactionIndex", "from", "to", "value", "gas", "gasUsed", "gasPrice", "input", "isError", "txreceipt_status"),
    "transfers": TEXT("blockNumber", "timeStamp", "hash", "transactionHash", "transactionIndex", "logIndex", "from", "to", "contractAddress", "value", "tokenName", "tokenSymbol", "tokenDecimal"),
    "internals": TEXT("hash", "traceId", "blockNumber", "timeStamp", "from", "to", "value", "type", "isError"),
    "withdrawals": TEXT("withdrawalIndex", "validatorIndex", "blockNumber", "timestamp", "time_stamp", "blockTimestamp", "address", "amount"),
    "holdings": TEXT("TokenAddress", "TokenName", "TokenSymbol", "TokenDivisor", "TokenQuantity"),
}
CURSOR_TRANSACTION = TEXT("hash", "nonce", "transaction_index", "from_address", "to_address", "value", "gas", "gas_price", "input", "receipt_gas_used", "receipt_status", "block_timestamp", "block_number", "block_hash")
CURSOR_TRANSFER = TEXT("token_name", "token_symbol", "token_decimals", "transaction_hash", "address", "block_timestamp", "block_number", "from_address", "to_address", "from_wallet", "to_wallet", "value", "transaction_index", "log_index")
CURSOR_HOLDING = TEXT("token_address", "balance", "decimals", "name", "symbol")
RPC_TRANSFER = "struct<category:string,uniqueId:string,asset:string,from:string,to:string,hash:string,blockNum:string,rawContract:struct<address:string,decimals:string,decimal:string,value:string>,metadata:struct<blockTimestamp:string>>"


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """file, body: each landed document as text, with an explicit schema and nothing inferred."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("body"))


def triage(envelopes: DataFrame, kind: str = "transactions") -> DataFrame:
    """outcome of each explorer envelope (body): ok, empty, error, or malformed; and its result.

    An envelope of status 0 is empty only if its message, or its result where that is text, says so in the words of its
    kind; any other is an error, an empty list or not.
    """
    # through a generator, so that filters on its fields are not pushed below it and parse once more for each
    rows = envelopes.select("*", F.explode(F.array(F.from_json("body", "status string, message string, result string"))).alias("e"))
    told = F.when(~F.col("e.result").startswith("["), F.col("e.result"))
    said = F.lower(F.concat_ws(" ", "e.message", told))
    nothing = said.rlike(NOTHING.get(kind, NOTHING["transfers"]))
    outcome = F.when(F.col("e.status").isNull(), "malformed").when(F.col("e.status") != "0", "ok").when(nothing, "empty").otherwise("error")
    return rows.withColumn("outcome", outcome).withColumn("result", F.col("e.result")).drop("e")


def rows_of(envelopes: DataFrame, kind: str) -> DataFrame:
    """ordinal and r, the typed records of envelopes that are ok; all other columns stay."""
    ok = triage(envelopes, kind).filter("outcome = 'ok'").drop("outcome", "body")
    # two fields of withdrawals differ only in case, which column names do not tell apart
    text = F.regexp_replace("result", r'"timeStamp"\s*:', '"time_stamp":') if kind == "withdrawals" else F.col("result")
    typed = ok.withColumn("__rows", F.from_json(text, f"array<{EXPLORER[kind]}>")).drop("result")
    return _each(typed, [c for c in typed.columns if c != "__rows"], F.col("__rows"))


def _each(rows: DataFrame, keep: list[str], records: Column) -> DataFrame:
    """ordinal and r, the elements of an array; the outer form, as the other one makes Spark parse once more for a filter of empty arrays."""
    return rows.select(*keep, F.posexplode_outer(records).alias("ordinal", "r")).filter("ordinal is not null")


def explorer_transactions(rows: DataFrame, provider: str) -> DataFrame:
    r = lambda c: F.col(f"r.{c}")
    return _with_block(rows.select("chain_id", s.nullable_lower(r("hash")).alias("tx_hash"), s.canonical_decimal(r("blockNumber")).alias("block_number"), s.nullable_lower(r("blockHash")).alias("block_hash"), s.nullable_decimal(r("transactionIndex")).alias("transaction_index"), s.epoch_seconds(r("timeStamp")).alias("ts"), s.nullable_lower(r("from")).alias("from_address"), s.nullable_lower(r("to")).alias("to_address"), s.nullable_decimal(r("nonce")).alias("nonce"), s.canonical_decimal(r("value")).alias("value"), s.nullable_decimal(r("gas")).alias("gas_limit"), s.nullable_decimal(r("gasUsed")).alias("gas_used"), s.nullable_decimal(r("gasPrice")).alias("gas_price"), r("input").alias("input"), s.tx_status(r("isError"), r("txreceipt_status")).alias("status"), F.lit(provider).alias("provider"), "ordinal"))


def explorer_transfers(rows: DataFrame, provider: str) -> DataFrame:
    r = lambda c: F.col(f"r.{c}")
    tx = F.coalesce(s.nullable_lower(r("transactionHash")), s.nullable_lower(r("hash")))
    return _with_block(rows.select("chain_id", s.nullable_lower(r("contractAddress")).alias("token_address"), tx.alias("tx_hash"), s.nullable_decimal(r("transactionIndex")).alias("transaction_index"), s.nullable_decimal(r("logIndex")).alias("log_index"), s.canonical_decimal(r("blockNumber")).alias("block_number"), s.epoch_seconds(r("timeStamp")).alias("ts"), s.blank_to_null(r("tokenName")).alias("token_name"), s.blank_to_null(r("tokenSymbol")).alias("token_symbol"), s.token_decimals(r("tokenDecimal")).alias("token_decimals"), s.nullable_lower(r("from")).alias("from_address"), s.nullable_lower(r("to")).alias("to_address"), s.canonical_decimal(r("value")).alias("amount"), F.lit(provider).alias("provider"), "ordinal"))


def explorer_internals(rows: DataFrame, provider: str) -> DataFrame:
    r = lambda c: F.col(f"r.{c}")
    status = F.when(r("isError") == "1", "reverted").when(r("isError") == "0", "success").otherwise("unknown")
    return _with_block(rows.select("chain_id", s.nullable_lower(r("hash")).alias("tx_hash"), s.blank_to_null(r("traceId")).alias("trace_id"), s.canonical_decimal(r("blockNumber")).alias("block_number"), s.epoch_seconds(r("timeStamp")).alias("ts"), s.nullable_lower(r("from")).alias("from_address"), s.nullable_lower(r("to")).alias("to_address"), s.canonical_decimal(r("value")).alias("value"), s.blank_to_null(r("type")).alias("type"), status.alias("status"), F.lit(provider).alias("provider"), "ordinal"))


def explorer_withdrawals(rows: DataFrame, provider: str) -> DataFrame:
    """Beacon withdrawals in Gwei; chain 1 only."""
    r = lambda c: F.col(f"r.{c}")
    when = F.coalesce(r("timestamp"), r("time_stamp"), r("blockTimestamp"))
    return _with_block(rows.filter("chain_id = 1").select("chain_id", s.canonical_decimal(r("withdrawalIndex")).alias("withdrawal_index"), s.nullable_decimal(r("validatorIndex")).alias("validator_index"), s.canonical_decimal(r("blockNumber")).alias("block_number"), s.epoch_seconds(when).alias("ts"), s.nullable_lower(r("address")).alias("address"), s.canonical_decimal(r("amount")).alias("amount"), F.lit(9).alias("amount_decimals"), F.lit(provider).alias("provider"), "ordinal"))


def explorer_holdings(rows: DataFrame, provider: str) -> DataFrame:
    r = lambda c: F.col(f"r.{c}")
    return rows.select("chain_id", s.nullable_lower(r("TokenAddress")).alias("token_address"), s.blank_to_null(r("TokenName")).alias("token_name"), s.blank_to_null(r("TokenSymbol")).alias("token_symbol"), s.token_decimals(r("TokenDivisor")).alias("token_decimals"), s.canonical_decimal(r("TokenQuantity")).alias("amount"), F.lit(provider).alias("provider"), "ordinal")


def native_balance(rows: DataFrame, chains: DataFrame, provider: str) -> DataFrame:
    """amount of rows (chain_id, address, balance: decimal or 0x text) beside the chain's symbol and decimals."""
    amount = F.when(F.col("balance").startswith("0x"), s.hex_to_decimal(F.col("balance"))).otherwise(s.canonical_decimal(F.col("balance")))
    return rows.join(chains.select("chain_id", "symbol", "decimals"), "chain_id").select("chain_id", s.nullable_lower(F.col("address")).alias("address"), amount.alias("amount"), "symbol", "decimals", F.lit(provider).alias("provider"))


def cursor_transactions(pages: DataFrame, provider: str) -> DataFrame:
    """Transactions of the cursor dialect (body: result array)."""
    r = lambda c: F.col(f"r.{c}")
    status = F.when(r("receipt_status") == "1", "success").when(r("receipt_status") == "0", "reverted").otherwise("unknown")
    return _with_block(_explode(pages, "result", CURSOR_TRANSACTION).select("chain_id", s.nullable_lower(r("hash")).alias("tx_hash"), s.canonical_decimal(r("block_number")).alias("block_number"), s.nullable_lower(r("block_hash")).alias("block_hash"), s.nullable_decimal(r("transaction_index")).alias("transaction_index"), s.iso_timestamp(r("block_timestamp")).alias("ts"), s.nullable_lower(r("from_address")).alias("from_address"), s.nullable_lower(r("to_address")).alias("to_address"), s.nullable_decimal(r("nonce")).alias("nonce"), s.canonical_decimal(r("value")).alias("value"), s.nullable_decimal(r("gas")).alias("gas_limit"), s.nullable_decimal(r("receipt_gas_used")).alias("gas_used"), s.nullable_decimal(r("gas_price")).alias("gas_price"), r("input").alias("input"), status.alias("status"), F.lit(provider).alias("provider"), "ordinal"))


def cursor_transfers(pages: DataFrame, provider: str) -> DataFrame:
    r = lambda c: F.col(f"r.{c}")
    side = lambda a, b: F.coalesce(s.nullable_lower(r(a)), s.nullable_lower(r(b)))
    return _with_block(_explode(pages, "result", CURSOR_TRANSFER).select("chain_id", s.nullable_lower(r("address")).alias("token_address"), s.nullable_lower(r("transaction_hash")).alias("tx_hash"), s.nullable_decimal(r("transaction_index")).alias("transaction_index"), s.nullable_decimal(r("log_index")).alias("log_index"), s.canonical_decimal(r("block_number")).alias("block_number"), s.iso_timestamp(r("block_timestamp")).alias("ts"), s.blank_to_null(r("token_name")).alias("token_name"), s.blank_to_null(r("token_symbol")).alias("token_symbol"), s.token_decimals(r("token_decimals")).alias("token_decimals"), side("from_address", "from_wallet").alias("from_address"), side("to_address", "to_wallet").alias("to_address"), s.canonical_decimal(r("value")).alias("amount"), F.lit(provider).alias("provider"), "ordinal"))


def cursor_holdings(pages: DataFrame, provider: str) -> DataFrame:
    r = lambda c: F.col(f"r.{c}")
    return _explode(pages, "result", CURSOR_HOLDING).select("chain_id", s.nullable_lower(r("token_address")).alias("token_address"), s.blank_to_null(r("name")).alias("token_name"), s.blank_to_null(r("symbol")).alias("token_symbol"), s.token_decimals(r("decimals")).alias("token_decimals"), s.canonical_decimal(r("balance")).alias("amount"), F.lit(provider).alias("provider"), "ordinal")


def contexts(bodies: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Transaction contexts with the fee, their logs, and logs of another transaction, which are refused."""
    log = "struct<" + ",".join(f"{n}:string" for n in ("log_index", "transaction_hash", "address", "data", "topic0", "topic1", "topic2", "topic3")) + ">"
    shape = f"hash string, block_number string, gas_price string, receipt_gas_used string, receipt_status string, logs array<{log}>"
    rows = bodies.select("chain_id", F.from_json("body", shape).alias("c"))
    used, price = s.nullable_decimal(F.col("c.receipt_gas_used")), s.nullable_decimal(F.col("c.gas_price"))
    tx = s.nullable_lower(F.col("c.hash"))
    heads = rows.select("chain_id", tx.alias("tx_hash"), s.canonical_decimal(F.col("c.block_number")).alias("block_number"), used.alias("gas_used"), price.alias("gas_price"), s.gas_fee(used, price).alias("gas_fee"))
    each = rows.select("chain_id", tx.alias("tx_hash"), F.explode("c.logs").alias("l"))
    topics = F.filter(F.array(*[F.col(f"l.topic{k}") for k in range(4)]), lambda t: t.isNotNull() & (t != ""))
    logs = each.select("chain_id", "tx_hash", s.nullable_lower(F.col("l.transaction_hash")).alias("log_tx"), s.nullable_decimal(F.col("l.log_index")).alias("log_index"), s.nullable_lower(F.col("l.address")).alias("address"), topics.alias("topics"), F.col("l.data").alias("data"))
    mine = F.coalesce(F.col("log_tx") == F.col("tx_hash"), F.lit(False))
    return heads, logs.filter(mine).drop("log_tx"), logs.filter(~mine)


def rpc_transfers(pages: DataFrame, provider: str, category: str = "erc20") -> DataFrame:
    """Transfers of the JSON-RPC dialect, whose quantities are 0x text; category erc20, external or internal."""
    r = lambda c: F.col(f"r.{c}")
    rows = _explode(pages, "result.transfers", RPC_TRANSFER).filter(r("category") == category)
    tx, value = s.nullable_lower(r("hash")), s.hex_to_decimal(r("rawContract.value"))
    base = ["chain_id", tx.alias("tx_hash"), s.hex_to_decimal(r("blockNum")).alias("block_number"), s.iso_timestamp(r("metadata.blockTimestamp")).alias("ts"), s.nullable_lower(r("from")).alias("from_address"), s.nullable_lower(r("to")).alias("to_address")]
    if category == "erc20":
        more = [s.nullable_lower(r("rawContract.address")).alias("token_address"), s.log_index_of(r("uniqueId"), r("hash")).alias("log_index"), s.blank_to_null(r("asset")).alias("token_symbol"), s.token_decimals(F.coalesce(r("rawContract.decimal"), r("rawContract.decimals"))).alias("token_decimals"), value.alias("amount"), r("uniqueId").alias("source_id")]
    elif category == "internal":
        more = [r("uniqueId").alias("trace_id"), value.alias("value"), F.lit("internal").alias("type"), F.lit("unknown").alias("status")]
    else:
        more = [value.alias("value"), F.lit("unknown").alias("status")]
    return _with_block(rows.select(*base, *more, F.lit(provider).alias("provider"), "ordinal"))


def _explode(pages: DataFrame, path: str, kind: str) -> DataFrame:
    outer, _, inner = path.partition(".")
    shape = f"{outer} struct<{inner}:array<{kind}>>" if inner else f"{outer} array<{kind}>"
    found = F.from_json("body", shape)[outer]
    return _each(pages, ["chain_id"], found[inner] if inner else found)


def _with_block(rows: DataFrame) -> DataFrame:
    """block, the number as a long, for ranges and order; the text stays for output."""
    return rows.withColumn("block", F.col("block_number").try_cast("bigint"))


def quarantine(rows: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that have all required columns, and the others."""
    whole = F.lit(True)
    for c in required:
        whole = whole & F.col(c).isNotNull()
    return rows.filter(whole), rows.filter(~whole)


#: Mappers by dialect and kind; :func:`register` adds one.
MAPPERS: dict[tuple[str, str], tuple[Callable[[DataFrame, str], DataFrame], tuple[str, ...]]] = {
    ("explorer", "transactions"): (explorer_transactions, ("tx_hash", "block", "value")),
    ("explorer", "transfers"): (explorer_transfers, ("tx_hash", "block", "amount")),
    ("explorer", "internals"): (explorer_internals, ("tx_hash", "block", "value")),
    ("explorer", "withdrawals"): (explorer_withdrawals, ("withdrawal_index", "block", "amount")),
    ("explorer", "holdings"): (explorer_holdings, ("token_address", "amount")),
    ("cursor", "transactions"): (cursor_transactions, ("tx_hash", "block", "value")),
    ("cursor", "transfers"): (cursor_transfers, ("tx_hash", "block", "amount")),
    ("cursor", "holdings"): (cursor_holdings, ("token_address", "amount")),
    ("rpc", "transfers"): (rpc_transfers, ("tx_hash", "block", "amount")),
    ("rpc", "transactions"): (lambda raw, provider: rpc_transfers(raw, provider, "external"), ("tx_hash", "block", "value")),
    ("rpc", "internals"): (lambda raw, provider: rpc_transfers(raw, provider, "internal"), ("tx_hash", "block", "trace_id", "value")),
}


def register(dialect: str, kind: str, mapper: Callable[[DataFrame, str], DataFrame], required: tuple[str, ...]) -> None:
    """A provider of one's own: mapper(raw rows, provider) whose result has at least the required columns."""
    MAPPERS[dialect, kind] = (mapper, required)


def normalise(dialect: str, kind: str, raw: DataFrame, provider: str) -> DataFrame:
    mapper, required = MAPPERS[dialect, kind]
    rows = mapper(rows_of(raw, kind) if dialect == "explorer" else raw, provider)
    if lacking := [c for c in required if c not in rows.columns]:
        raise ValueError(f"the mapper lacks {lacking}")
    return rows


def active_markets(markets: DataFrame, exchange: str) -> DataFrame:
    """Markets open for spot trading, by each exchange's own flags; a flag that is not told does not close a market."""
    c, told = F.col, lambda name, unless: F.coalesce(F.col(name), F.lit(unless))
    rules: dict[str, Column] = {
        "a": (c("status") == "TRADING") & told("spot_allowed", True),
        "b": (c("type") == "SPOT") & (c("state") == "live"),
        "c": ~(told("status", "").isin("delisted", "offline") | told("trading_disabled", False) | told("cancel_only", False) | told("post_only", False)),
    }
    return markets.filter(F.coalesce(rules[exchange], F.lit(False)))
