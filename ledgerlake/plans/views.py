"""The given star-schema tables seen as ledger facts; SQL gives the same views to the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.ledger import ZERO


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _block(c: str):
    return F.datediff(F.to_date(c), F.lit("1995-01-01").cast("date")).cast("bigint")


def transfers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as transfers from a supplier to a customer, of one of 50 tokens; amounts in cents as text."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        F.lit(1).cast("bigint").alias("chain_id"),
        F.concat(F.lit("c"), "o_custkey").alias("address"),
        F.col("l_orderkey").cast("string").alias("tx_hash"),
        F.col("l_linenumber").cast("bigint").alias("log_index"),
        _block("o_orderdate").alias("block"),
        F.concat(F.lit("t"), F.col("l_partkey") % 50).alias("token_address"),
        F.concat(F.lit("s"), "l_suppkey").alias("from_address"),
        F.concat(F.lit("c"), "o_custkey").alias("to_address"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string").alias("amount"),
        F.when(F.col("l_returnflag") == "R", "own").otherwise("external").alias("ingestion_source"),
    )


def moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a replay reads of the transfers."""
    return transfers(spark, sf_dir).select("chain_id", "from_address", "to_address", "token_address", "block", "amount")


def minted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers of one token, of which first lines are mints and second ones are sent by the customer."""
    t = transfers(spark, sf_dir).withColumn("token_address", F.lit("t"))
    own = F.col("to_address")
    return t.withColumn("from_address", F.when(F.col("log_index") == 1, ZERO).when(F.col("log_index") == 2, own).otherwise(F.col("from_address"))).withColumn("to_address", F.when(F.col("log_index") == 2, "s0").otherwise(own))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "P", "reverted").otherwise("unknown")
    return table(spark, sf_dir, "orders").select(
        F.lit(1).cast("bigint").alias("chain_id"),
        F.concat(F.lit("c"), "o_custkey").alias("address"),
        F.col("o_orderkey").cast("string").alias("tx_hash"),
        _block("o_orderdate").alias("block"),
        F.concat(F.lit("c"), "o_custkey").alias("from_address"),
        F.concat(F.lit("s"), F.col("o_orderkey") % 100).alias("to_address"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string").alias("value"),
        status.alias("status"),
    )


def internals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An internal leg for each line item; those of the first line repeat their order's transaction leg."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    own = F.col("l_linenumber") == 1
    return rows.select(
        F.lit(1).cast("bigint").alias("chain_id"),
        F.concat(F.lit("c"), "o_custkey").alias("address"),
        F.col("l_orderkey").cast("string").alias("tx_hash"),
        F.concat_ws("_", F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.lpad(F.col("l_partkey").cast("string"), 9, "0"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("trace_id"),
        _block("o_orderdate").alias("block"),
        F.concat(F.lit("c"), "o_custkey").alias("from_address"),
        F.when(own, F.concat(F.lit("s"), F.col("o_orderkey") % 100)).otherwise(F.concat(F.lit("s"), "l_suppkey")).alias("to_address"),
        F.when(own, F.round(F.col("o_totalprice") * 100).cast("bigint")).otherwise(F.round(F.col("l_extendedprice") * 100).cast("bigint")).cast("string").alias("value"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as price points of a token named by their type, in cents as whole numbers."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("token_key"), F.lit("x").alias("exchange"), F.lit("spot").alias("market"), F.lit("USD").alias("quote"), F.lit("1m").alias("interval"),
        F.col("ts").cast("timestamp").alias("ts"), F.round(F.col("value") * 100).cast("bigint").alias("price"), F.col("event_id").alias("ordinal"),
    )


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An asking for the price of ``purchase``-like tokens at the time of every event, by turns before and after it."""
    e = table(spark, sf_dir, "events")
    kinds = F.array(*map(F.lit, ("click", "error", "purchase", "signup", "view")))
    token = F.get(kinds, (F.col("user_id") % 5).cast("int"))
    return e.select(token.alias("token_key"), F.lit("x").alias("exchange"), F.lit("spot").alias("market"), F.lit("USD").alias("quote"), F.lit("1m").alias("interval"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("request"))


SQL = """
WITH v_transfers AS (
  SELECT CAST(1 AS BIGINT) AS chain_id, 'c' || o_custkey AS address, CAST(l_orderkey AS VARCHAR) AS tx_hash, CAST(l_linenumber AS BIGINT) AS log_index,
    date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS block, 't' || (l_partkey % 50) AS token_address,
    's' || l_suppkey AS from_address, 'c' || o_custkey AS to_address, CAST(round(l_extendedprice * 100) AS BIGINT) AS amount,
    CASE WHEN l_returnflag = 'R' THEN 'own' ELSE 'external' END AS ingestion_source
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
v_transactions AS (
  SELECT CAST(1 AS BIGINT) AS chain_id, 'c' || o_custkey AS address, CAST(o_orderkey AS VARCHAR) AS tx_hash,
    date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS block, 'c' || o_custkey AS from_address, 's' || (o_orderkey % 100) AS to_address,
    CAST(round(o_totalprice * 100) AS BIGINT) AS value, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'reverted' ELSE 'unknown' END AS status
  FROM orders),
v_internals AS (
  SELECT CAST(1 AS BIGINT) AS chain_id, 'c' || o_custkey AS address, CAST(l_orderkey AS VARCHAR) AS tx_hash,
    lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || '_' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') || '_' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS trace_id,
    date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS block, 'c' || o_custkey AS from_address,
    CASE WHEN l_linenumber = 1 THEN 's' || (o_orderkey % 100) ELSE 's' || l_suppkey END AS to_address,
    CASE WHEN l_linenumber = 1 THEN CAST(round(o_totalprice * 100) AS BIGINT) ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
v_prices AS (SELECT event_type AS token_key, ts, CAST(round(value * 100) AS BIGINT) AS price, event_id AS ordinal FROM events),
v_probes AS (SELECT list_extract(['click', 'error', 'purchase', 'signup', 'view'], CAST(user_id % 5 AS INTEGER) + 1) AS token_key, ts, event_id AS request FROM events),
v_entries AS (
  SELECT chain_id, to_address AS account, token_address, tx_hash, block, amount AS gained, CAST(0 AS BIGINT) AS lost FROM v_transfers
  UNION ALL SELECT chain_id, from_address, token_address, tx_hash, block, 0, amount FROM v_transfers)
"""
#: Balances of the transfers of :func:`minted`.
MINTED_BALANCES = f"""SELECT chain_id, account AS address, token_address, CAST(sum(gained) - sum(lost) AS VARCHAR) AS amount, CAST(sum(CASE WHEN minted AND sends THEN 0 ELSE gained END) AS VARCHAR) AS incoming, CAST(sum(lost) AS VARCHAR) AS outgoing FROM (
  SELECT *, bool_or(gives) OVER (PARTITION BY chain_id, account, tx_hash, token_address) AS sends FROM (
    SELECT chain_id, CASE WHEN log_index = 2 THEN 's0' ELSE to_address END AS account, 't' AS token_address, tx_hash, amount AS gained, CAST(0 AS BIGINT) AS lost, log_index = 1 AS minted, false AS gives FROM v_transfers
    UNION ALL SELECT chain_id, CASE log_index WHEN 1 THEN '{ZERO}' WHEN 2 THEN to_address ELSE from_address END, 't', tx_hash, 0, amount, false, true FROM v_transfers)) GROUP BY ALL"""
