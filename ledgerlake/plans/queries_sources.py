"""Registered queries of sources, registries and scalar functions: payloads made of the given tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import scalars as s
from ledgerlake.functions import u256
from ledgerlake.operators import identity, lookup, selection
from ledgerlake.plans import views as v
from ledgerlake.plans.registry import query
from ledgerlake.sources import candles, payloads

_CENTS = "CAST(round({} * 100) AS BIGINT)"


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def hexed(c: Column, width: int = 0) -> Column:
    text = F.lower(F.hex(c.cast("bigint")))
    return F.concat(F.lit("0x"), F.lpad(text, width, "0") if width else text)


def envelope(rows: DataFrame, record: Column, *scope: Column) -> DataFrame:
    """One explorer envelope for each row."""
    body = F.to_json(F.struct(F.lit("1").alias("status"), F.lit("OK").alias("message"), F.array(record).alias("result")))
    return rows.select(*(scope or (F.lit(1).cast("bigint").alias("chain_id"),)), body.alias("body"))


def page(rows: DataFrame, record: Column, *path: str) -> DataFrame:
    inner = F.array(record)
    for name in reversed(path):
        inner = F.struct(inner.alias(name))
    return rows.select(F.lit(1).cast("bigint").alias("chain_id"), F.to_json(inner).alias("body"))


def record(**fields: Column) -> Column:
    return F.struct(*[c.alias(n.rstrip("_")) for n, c in fields.items()])


@query(f"""SELECT CAST(l_orderkey AS VARCHAR) AS tx_hash, CAST(l_linenumber AS VARCHAR) AS log_index, 't' || (l_partkey % 50) AS token_address, 18 AS token_decimals, CASE WHEN l_linenumber > 2 THEN 'SYM' END AS token_symbol,
'a' || l_suppkey AS from_address, CAST({_CENTS.format('l_extendedprice')} AS VARCHAR) AS amount, make_timestamp(1700000000000000 + CAST(l_orderkey AS BIGINT) * 1000000) AS ts FROM lineitem""")
def explorer_transfer_payloads(spark, d):
    """Token transfers of the explorer dialect; the older hash field where the newer one is blank."""
    t = v.table(spark, d, "lineitem")
    tx = F.col("l_orderkey").cast("string")
    blank = F.col("l_linenumber") % 2 == 0
    r = record(blockNumber=F.lit("007"), timeStamp=(F.lit(1700000000) + F.col("l_orderkey")).cast("string"), hash=F.when(blank, tx).otherwise("other"), transactionHash=F.when(blank, "").otherwise(tx), logIndex=F.concat(F.lit("00"), "l_linenumber"), from_=F.concat(F.lit("A"), "l_suppkey"), to=F.lit("0xB"), contractAddress=F.concat(F.lit("T"), F.col("l_partkey") % 50), value=F.concat(F.lit("00"), cents("l_extendedprice")), tokenSymbol=F.when(F.col("l_linenumber") > 2, " SYM ").otherwise(" "), tokenDecimal=F.lit("018"))
    return payloads.normalise("explorer", "transfers", envelope(t, r), "e").select("tx_hash", "log_index", "token_address", "token_decimals", "token_symbol", "from_address", "amount", "ts")


@query(f"""SELECT CAST(l_orderkey AS VARCHAR) AS tx_hash, CASE WHEN l_linenumber <> 3 THEN 'x_' || l_linenumber END AS trace_id, CAST({_CENTS.format('l_extendedprice')} AS VARCHAR) AS value,
CASE l_returnflag WHEN 'R' THEN 'reverted' WHEN 'A' THEN 'success' ELSE 'unknown' END AS status, CASE WHEN l_linestatus = 'O' THEN 'call' END AS type, 'e' AS provider FROM lineitem""")
def explorer_internal_payloads(spark, d):
    """Internal transfers of the explorer dialect with their three states."""
    t = v.table(spark, d, "lineitem")
    r = record(hash=F.col("l_orderkey").cast("string"), traceId=F.when(F.col("l_linenumber") != 3, F.concat(F.lit("x_"), "l_linenumber")).otherwise(" "), blockNumber=F.lit("9"), timeStamp=F.lit("1700000000"), from_=F.lit("0xA"), to=F.lit("0xB"), value=cents("l_extendedprice").cast("string"), type=F.when(F.col("l_linestatus") == "O", "call").otherwise(""), isError=F.when(F.col("l_returnflag") == "R", "1").when(F.col("l_returnflag") == "A", "0"))
    return payloads.normalise("explorer", "internals", envelope(t, r), "e").select("tx_hash", "trace_id", "value", "status", "type", "provider")


@query("SELECT CAST(event_id AS VARCHAR) AS withdrawal_index, CAST(user_id AS VARCHAR) AS validator_index, '0x' || lower(event_type) AS address, CAST(event_id * 7 AS VARCHAR) AS amount, 9 AS amount_decimals, make_timestamp(1700000000000000) AS ts FROM events WHERE event_id % 2 = 1")
def explorer_withdrawal_payloads(spark, d):
    """Withdrawals in Gwei, of chain 1 only, with the time in any of three fields."""
    e = v.table(spark, d, "events")
    when = lambda k: F.when(F.col("event_id") % 3 == k, "1700000000")
    r = record(withdrawalIndex=F.concat(F.lit("0"), "event_id"), validatorIndex=F.col("user_id").cast("string"), blockNumber=F.lit("5"), timestamp=when(0), timeStamp=when(1), blockTimestamp=when(2), address=F.concat(F.lit("0x"), F.upper("event_type")), amount=(F.col("event_id") * 7).cast("string"))
    raw = envelope(e, r, (F.when(F.col("event_id") % 2 == 1, 1).otherwise(10)).cast("bigint").alias("chain_id"))
    return payloads.normalise("explorer", "withdrawals", raw, "e").select("withdrawal_index", "validator_index", "address", "amount", "amount_decimals", "ts")


@query("SELECT 't' || p_size AS token_address, CAST(min(p_partkey) AS VARCHAR) AS amount, count(*) - 1 AS further FROM part WHERE p_partkey % 5 <> 0 GROUP BY p_size")
def explorer_holding_payloads(spark, d):
    """Holdings that are not zero, the first row of each token, and how many more there were."""
    p = v.table(spark, d, "part")
    r = record(TokenAddress=F.concat(F.lit("T"), "p_size"), TokenName=F.col("p_name"), TokenSymbol=F.lit("S"), TokenDivisor=F.lit("18"), TokenQuantity=F.when(F.col("p_partkey") % 5 == 0, "000").otherwise(F.concat(F.lit("0"), "p_partkey")))
    rows = selection.non_zero(payloads.normalise("explorer", "holdings", envelope(p, r), "e")).withColumn("n", F.col("amount").cast("bigint"))
    first = identity.first_wins(rows.select("token_address", "amount", "n"), ["token_address"], ["n"])
    more = identity.duplicate_keys(rows, ["token_address"]).select("token_address", (F.col("n") - 1).alias("further"))
    return first.join(more, "token_address", "left").select("token_address", "amount", F.coalesce("further", F.lit(0)).cast("bigint").alias("further"))


@query("SELECT [1, 56, 137, 10][CAST(c_custkey % 4 AS INTEGER) + 1] AS chain_id, '0x' || c_custkey AS address, CAST(c_custkey * 1000 AS VARCHAR) AS amount, ['ETH', 'BNB', 'POL', 'ETH'][CAST(c_custkey % 4 AS INTEGER) + 1] AS symbol, 18 AS decimals FROM customer")
def native_balance_readings(spark, d):
    """Native balances told in decimal or hexadecimal digits, with the chain's currency."""
    c = v.table(spark, d, "customer")
    n = F.col("c_custkey") * 1000
    rows = c.select(F.get(F.array(*[F.lit(x).cast("bigint") for x in (1, 56, 137, 10)]), (F.col("c_custkey") % 4).cast("int")).alias("chain_id"), F.concat(F.lit("0X"), "c_custkey").alias("address"), F.when(F.col("c_custkey") % 2 == 0, hexed(n)).otherwise(F.concat(F.lit("00"), n)).alias("balance"))
    return payloads.native_balance(rows, candles.chains(spark), "p").select(F.col("chain_id").cast("int").alias("chain_id"), "address", "amount", "symbol", "decimals")


@query(f"""SELECT CAST(o_orderkey AS VARCHAR) AS tx_hash, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'reverted' ELSE 'unknown' END AS status, CAST({_CENTS.format('o_totalprice')} AS VARCHAR) AS value, CASE WHEN o_custkey % 2 = 0 THEN 'c' || o_custkey END AS to_address,
CAST(o_orderdate AS DATE) AS day, CAST(o_custkey AS VARCHAR) AS nonce FROM orders""")
def cursor_transaction_payloads(spark, d):
    """Transactions of the cursor dialect, with ISO times."""
    o = v.table(spark, d, "orders")
    r = record(hash=F.col("o_orderkey").cast("string"), nonce=F.col("o_custkey").cast("string"), from_address=F.lit("0xA"), to_address=F.when(F.col("o_custkey") % 2 == 0, F.concat(F.lit("C"), "o_custkey")).otherwise(""), value=cents("o_totalprice").cast("string"), receipt_status=F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "P", "0"), block_timestamp=F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), block_number=F.lit("12"), block_hash=F.lit("0xH"))
    return payloads.normalise("cursor", "transactions", page(o, r, "result"), "c").select("tx_hash", "status", "value", "to_address", F.to_date("ts").alias("day"), "nonce")


@query("SELECT 't' || p_partkey AS token_address, CAST(p_size AS VARCHAR) AS amount, CASE WHEN p_size < 30 THEN CAST(p_size AS INTEGER) END AS token_decimals, p_brand AS token_symbol FROM part")
def cursor_holding_payloads(spark, d):
    """Holdings of the cursor dialect; decimals that are none are null."""
    p = v.table(spark, d, "part")
    r = record(token_address=F.concat(F.lit("T"), "p_partkey"), balance=F.concat(F.lit("0"), "p_size"), decimals=F.when(F.col("p_size") < 30, F.col("p_size").cast("string")).otherwise("300"), name=F.col("p_name"), symbol=F.col("p_brand"))
    return payloads.normalise("cursor", "holdings", page(p, r, "result"), "c").select("token_address", "amount", "token_decimals", "token_symbol")


def _contexts(spark, d):
    o = v.table(spark, d, "orders")
    tx = F.col("o_orderkey").cast("string")
    log = lambda k, of, topic: record(log_index=F.lit(str(k)), transaction_hash=of, address=F.lit("0xC"), data=F.lit("0x"), topic0=F.lit("t"), topic1=topic, topic2=F.lit(None).cast("string"))
    c = record(hash=F.concat(F.lit("0X"), tx), block_number=F.lit("8"), gas_price=F.concat(cents("o_totalprice"), F.lit("0" * 20)), receipt_gas_used=F.concat(F.lit("0"), F.col("o_custkey")), logs=F.array(log(0, F.concat(F.lit("0x"), tx), F.lit("")), log(1, F.when(F.col("o_custkey") % 3 == 0, "0xother").otherwise(F.concat(F.lit("0x"), tx)), F.lit("u"))))
    return payloads.contexts(o.select(F.lit(1).cast("bigint").alias("chain_id"), F.to_json(c).alias("body")))


@query(f"SELECT '0x' || o_orderkey AS tx_hash, CAST(CAST(o_custkey AS HUGEINT) * {_CENTS.format('o_totalprice')} AS VARCHAR) || repeat('0', 20) AS gas_fee FROM orders WHERE o_custkey % 7 = 1")
def transaction_contexts(spark, d):
    """Contexts of a set of transactions, with fees beyond 64 bits."""
    asked = v.table(spark, d, "orders").filter("o_custkey % 7 = 1").select(F.explode(F.array(F.concat(F.lit(" 0X"), "o_orderkey"), F.concat(F.lit("0x"), "o_orderkey"), F.lit(""))).alias("tx_hash"))
    return selection.by_hashes(_contexts(spark, d)[0], asked).select("tx_hash", "gas_fee")


@query("""SELECT '0x' || o_orderkey AS tx_hash, CAST(k AS VARCHAR) AS log_index, CASE k WHEN 0 THEN ['t'] ELSE ['t', 'u'] END AS topics, k = 0 OR o_custkey % 3 <> 0 AS own FROM orders, range(2) r(k)""")
def transaction_logs(spark, d):
    """Logs of contexts with the topics they have, and those that belong to another transaction."""
    _, logs, wrong = _contexts(spark, d)
    return logs.withColumn("own", F.lit(True)).unionByName(wrong.drop("log_tx").withColumn("own", F.lit(False))).select("tx_hash", "log_index", "topics", "own")


@query(f"""SELECT 'external' AS kind, CAST(o_orderkey AS VARCHAR) AS tx_hash, CAST(NULL AS VARCHAR) AS trace_id, CAST({_CENTS.format('o_totalprice')} AS VARCHAR) AS value, o_custkey AS block FROM orders WHERE o_orderkey % 2 = 0
UNION ALL SELECT 'internal', CAST(o_orderkey AS VARCHAR), o_orderkey || ':internal', CAST({_CENTS.format('o_totalprice')} AS VARCHAR), o_custkey FROM orders WHERE o_orderkey % 2 = 1""")
def rpc_native_payloads(spark, d):
    """External transactions and internal transfers of the JSON-RPC dialect."""
    o = v.table(spark, d, "orders")
    even = F.col("o_orderkey") % 2 == 0
    r = record(category=F.when(even, "external").otherwise("internal"), uniqueId=F.concat("o_orderkey", F.lit(":internal")), hash=F.col("o_orderkey").cast("string"), blockNum=hexed(F.col("o_custkey")), from_=F.lit("0xA"), to=F.lit("0xB"), rawContract=F.struct(hexed(cents("o_totalprice")).alias("value")), metadata=F.struct(F.lit("2024-01-01T00:00:00.000Z").alias("blockTimestamp")))
    raw = page(o, r, "result", "transfers")
    ext = payloads.normalise("rpc", "transactions", raw, "r").select(F.lit("external").alias("kind"), "tx_hash", F.lit(None).cast("string").alias("trace_id"), "value", "block")
    return ext.unionByName(payloads.normalise("rpc", "internals", raw, "r").select(F.lit("internal").alias("kind"), "tx_hash", "trace_id", "value", "block"))


@query("""SELECT kind, outcome, count(*) AS n FROM (SELECT 'transactions' AS kind, ['ok', 'empty', 'error', 'malformed', 'error', 'error'][CAST(event_id % 6 AS INTEGER) + 1] AS outcome FROM events
UNION ALL SELECT 'transfers', ['ok', 'empty', 'error', 'malformed', 'error', 'empty'][CAST(event_id % 6 AS INTEGER) + 1] FROM events) GROUP BY ALL""")
def envelope_triage(spark, d):
    """The envelopes of a landing zone by outcome; an empty list does not make an error empty."""
    k = F.col("event_id") % 6
    made = lambda status, message, result: F.to_json(F.struct(F.lit(status).alias("status"), F.concat(F.lit(message), F.when(k < 0, F.col("event_type")).otherwise("")).alias("message"), result.alias("result")))
    none, row = F.array().cast("array<string>"), F.array(F.col("event_id").cast("string"))
    body = F.when(k == 0, made("1", "OK", row)).when(k == 1, made("0", "No transactions found", none)).when(k == 2, made("0", "NOTOK", F.lit("Max rate limit reached"))).when(k == 3, F.concat(F.lit("{"), "event_type")).when(k == 4, made("0", "NOTOK", none)).otherwise(made("0", "No records found", none))
    raw = v.table(spark, d, "events").select(body.alias("body"))
    parts = [payloads.triage(raw, kind).groupBy("outcome").agg(F.count("*").alias("n")).withColumn("kind", F.lit(kind)) for kind in ("transactions", "transfers")]
    return parts[0].unionByName(parts[1])


@query(f"""SELECT layout, event_type AS token_key, ts, CAST({_CENTS.format('value')} AS VARCHAR) AS close, CASE WHEN layout <> 'd' THEN CAST(event_id + 2 AS VARCHAR) END AS low, CASE WHEN layout <> 'd' THEN CAST(event_id + 3 AS VARCHAR) END AS high, CAST(event_id AS VARCHAR) AS volume
FROM (SELECT *, date_trunc('second', ts) AS t FROM events) e, (VALUES ('a'), ('c'), ('dex'), ('d'), ('own')) l(layout) WHERE {_CENTS.format('value')} > 0""".replace(" ts, CAST", " t AS ts, CAST", 1))
def more_candle_payloads(spark, d):
    """The candle layouts of four more sources and one that is registered here, each field at its place."""
    e = v.table(spark, d, "events")
    sec = F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string")
    ms = F.concat(sec, F.lit("000"))
    close, volume, low, high, other = cents("value").cast("string"), F.col("event_id").cast("string"), (F.col("event_id") + 2).cast("string"), (F.col("event_id") + 3).cast("string"), F.lit("1")
    candles.register("own", {"close": 1, "volume": 2, "low": 3, "high": 4}, "s", "rows")
    bodies = {
        "a": F.array(F.array(ms, other, high, low, close, volume)),
        "c": F.array(F.array(sec, low, high, other, close, volume)),
        "dex": F.struct(F.struct(F.struct(F.array(F.array(sec, other, high, low, close, volume)).alias("ohlcv_list")).alias("attributes")).alias("data")),
        "d": F.array(F.array(sec, volume, close, other, other, other)),
        "own": F.struct(F.array(F.array(sec, close, volume, low, high)).alias("rows")),
    }
    out = None
    for layout, body in bodies.items():
        got = candles.candles(e.select(F.col("event_type").alias("token_key"), F.to_json(body).alias("body")), layout).withColumn("layout", F.lit(layout))
        got = got.select("layout", "token_key", "ts", "close", *[(F.col(c) if c in got.columns else F.lit(None).cast("string")).alias(c) for c in ("low", "high", "volume")])
        out = got if out is None else out.unionByName(got)
    return out


@query("""SELECT 'a' AS exchange, p_partkey FROM part WHERE p_size % 3 = 0 AND p_partkey % 4 <> 1 UNION ALL SELECT 'b', p_partkey FROM part WHERE p_size % 3 = 1 AND p_partkey % 2 = 0
UNION ALL SELECT 'c', p_partkey FROM part WHERE p_size % 3 = 2 AND p_partkey % 6 NOT IN (1, 2, 4)""")
def active_markets(spark, d):
    """Markets open for spot trading by three exchanges' flags, some of them not told."""
    p, k = v.table(spark, d, "part"), F.col("p_partkey")
    part = lambda n: p.filter(F.col("p_size") % 3 == n)
    told = lambda x, c: F.when(k % x == c, True)
    a = part(0).select(k, F.lit("TRADING").alias("status"), F.when(k % 4 == 1, False).when(k % 4 == 2, True).alias("spot_allowed"))
    b = part(1).select(k, F.lit("SPOT").alias("type"), F.when(k % 2 == 0, "live").otherwise("suspend").alias("state"))
    c = part(2).select(k, F.when(k % 6 == 1, "delisted").when(k % 6 == 3, "online").alias("status"), told(6, 2).alias("trading_disabled"), told(6, 4).alias("cancel_only"), F.when(k % 6 == 5, False).alias("post_only"))
    rows = [payloads.active_markets(x, n).select(F.lit(n).alias("exchange"), "p_partkey") for n, x in (("a", a), ("b", b), ("c", c))]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _feeds(spark, d):
    p, k = v.table(spark, d, "part"), F.col("p_partkey")
    docs = F.struct(F.when(k % 11 == 1, "NAV").otherwise("RefPrice").alias("productTypeCode"), F.when(k % 11 == 2, "Equities").otherwise("Crypto").alias("assetClass"), F.when(k % 11 == 3, "ETH").otherwise("USD").alias("quoteAsset"), F.when(k % 2 == 0, F.concat(F.lit("B"), k)).alias("baseAsset"), F.when(k % 11 == 4, True).when(k % 11 == 5, False).alias("hidden"), F.when(k % 11 == 6, "2027").alias("shutdownDate"))
    name = F.concat(F.lit("t"), F.when(k % 50 == 20, k - 10).otherwise(k), F.lit(" / USD"))
    raw = p.select(F.concat(F.lit("p"), k, F.lit("-usd")).alias("path"), name.alias("name"), F.when(k % 13 == 0, "0x12").otherwise(F.concat(F.lit("0xA"), F.lpad(k.cast("string"), 39, "0"))).alias("proxyAddress"), F.when(k % 11 == 7, "0xS").alias("secondaryProxyAddress"), F.when(k % 3 == 0, F.col("p_name")).otherwise("").alias("assetName"), (k % 5 - 1).alias("heartbeat"), F.when(k % 17 == 0, 256).otherwise(8).alias("decimals"), docs.alias("docs"))
    return candles.standard_feeds(raw)


_FEED = "(SELECT *, p_partkey AS k, CASE WHEN p_partkey % 50 = 20 THEN p_partkey - 10 ELSE p_partkey END AS named FROM part WHERE p_partkey % 11 NOT IN (1, 2, 3, 4, 6, 7))"


@query(f"""SELECT 'ethereum-mainnet:p' || k || '-usd' AS feed_id, 't' || named AS asset_symbol, CASE WHEN k % 3 = 0 THEN p_name END AS asset_name, CASE WHEN k % 2 = 0 THEN 'B' || k ELSE 'T' || named END AS base_asset,
CAST(CASE WHEN k % 17 = 0 THEN 256 ELSE 8 END AS INTEGER) AS expected_decimals, CASE WHEN k % 5 >= 1 THEN CAST(k % 5 - 1 AS BIGINT) END AS heartbeat FROM {_FEED}""")
def feed_selection(spark, d):
    """Standard oracle feeds as a dimension."""
    return _feeds(spark, d)[0].select("feed_id", "asset_symbol", "asset_name", "base_asset", "expected_decimals", "heartbeat")


@query(f"""SELECT 'p' || k || '-usd' AS path, fault FROM (SELECT k, CASE WHEN k % 13 = 0 THEN 'ADDRESS' WHEN k % 17 = 0 THEN 'DECIMALS' END AS fault FROM {_FEED}
UNION ALL SELECT k, CASE WHEN k % 13 = 0 AND count(*) OVER (PARTITION BY k % 13 = 0) > 1 THEN 'DUPLICATE_PROXY' END FROM {_FEED}
UNION ALL SELECT k, CASE WHEN count(*) OVER (PARTITION BY named) > 1 THEN 'DUPLICATE_NAME' END FROM {_FEED}) WHERE fault IS NOT NULL""")
def feed_faults(spark, d):
    """What is wrong with the metadata of standard feeds, ids, proxies and names that repeat included."""
    return _feeds(spark, d)[1]


@query("SELECT p_partkey FROM part WHERE p_brand IN ('Brand#11', 'Brand#12', 'Brand#13') AND p_partkey % 10 <> 3 ORDER BY (p_partkey * 2654435761) % 4294967296 LIMIT 25")
def top_candidates(spark, d):
    """The first candidates by token address with a valid one and an allowed quote symbol."""
    mixed = F.pmod(F.col("p_partkey") * F.lit(2654435761), F.lit(4294967296))
    raw = v.table(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 10 == 3, "0x3").otherwise(F.concat(F.lit("0x"), F.lpad(F.hex(mixed), 40, "0"))).alias("token_address"), F.col("p_name").alias("symbol"), F.col("p_brand").alias("quote_symbol"))
    return candles.pool_candidates(raw, ["BRAND#11", "brand#12", "Brand#13"], 25).select("p_partkey")


@query("""SELECT CASE WHEN k % 97 = 5 THEN 'Bad ' || k ELSE 'ethereum:uniswap-v3:p' || k END AS id, fault FROM (
  SELECT k, CASE WHEN k % 97 = 5 THEN 'ID' WHEN k % 97 = 6 THEN 'ADDRESS' WHEN k % 97 = 7 THEN 'SIDES' WHEN k % 97 = 8 THEN 'QUOTE' WHEN k % 97 IN (9, 10, 11) THEN 'METADATA' END AS fault FROM (SELECT p_partkey AS k FROM part)
  UNION ALL SELECT k, 'DUPLICATE_POOL' FROM (SELECT p_partkey AS k, count(*) OVER (PARTITION BY CASE WHEN p_partkey % 97 = 13 THEN p_partkey - 1 ELSE p_partkey END) AS n FROM part) WHERE n > 1 AND k % 97 IN (12, 13)) WHERE fault IS NOT NULL""")
def registry_faults(spark, d):
    """Rows of a pool registry that break its rules."""
    p, k = v.table(spark, d, "part"), F.col("p_partkey")
    r = k % 97
    at = lambda n, c: F.concat(F.lit("0x"), F.lit(n), F.lpad(F.lower(F.hex(c)), 39, "0"))
    pool = F.when(r == 13, k - 1).otherwise(k)
    one, two = at("1", pool), at("2", pool)
    made = p.select(F.when(r == 5, F.concat(F.lit("Bad "), k)).otherwise(F.concat(F.lit("ethereum:uniswap-v3:p"), k)).alias("id"), F.when(r == 7, at("3", k)).otherwise(one).alias("token_address"), F.when(r == 6, None).otherwise(at("a", pool)).alias("pool_address"), one.alias("token0"), two.alias("token1"), F.when(r == 8, one).otherwise(two).alias("quote_token"), F.when(r == 9, 0).otherwise(3000).alias("fee"), F.when(r == 10, 256).otherwise(18).alias("decimals0"), F.lit(6).alias("decimals1"), F.when(r == 11, "-1").otherwise("12").alias("deployment_block"))
    return candles.registry_faults(made)


@query("""SELECT c_custkey AS request, code, id FROM (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'sym1' WHEN 1 THEN 'sym2' WHEN 2 THEN 'weth' WHEN 3 THEN '0x' || lpad(lower(to_hex(c_custkey % 40)), 40, '0') ELSE 'none' END AS ref FROM customer) q
JOIN (SELECT ref, CASE WHEN count(DISTINCT address) > 1 AND ref NOT LIKE '0x%' THEN 'TOKEN_AMBIGUOUS' END AS code, CASE WHEN count(DISTINCT address) > 1 AND ref NOT LIKE '0x%' THEN [CAST(NULL AS BIGINT)] ELSE list(id) END AS ids FROM (
  SELECT n_nationkey AS id, '0x' || lpad(lower(to_hex(n_nationkey)), 40, '0') AS address, CASE WHEN n_nationkey = 0 THEN 'weth' WHEN n_nationkey % 3 = 1 THEN 'sym1' ELSE 'sym' || n_nationkey END AS symbol FROM nation),
  LATERAL (SELECT unnest([address, symbol]) AS ref) GROUP BY ref UNION ALL SELECT 'none', 'TOKEN_UNKNOWN', [CAST(NULL AS BIGINT)] UNION ALL SELECT '0x' || lpad(lower(to_hex(k)), 40, '0'), 'TOKEN_UNKNOWN', [CAST(NULL AS BIGINT)] FROM range(25, 40) t(k)) r USING (ref), LATERAL (SELECT unnest(r.ids) AS id)""")
def token_lookup(spark, d):
    """Tokens by symbol, another name of one, or address; unknown and ambiguous ones told apart."""
    n, k = v.table(spark, d, "nation"), F.col("n_nationkey")
    registry = n.select(k.alias("id"), hexed(k, 40).alias("token_address"), F.when(k == 0, "WETH").when(k % 3 == 1, "Sym1").otherwise(F.concat(F.lit("SYM"), k)).alias("token_symbol"))
    c = F.col("c_custkey")
    asked = v.table(spark, d, "customer").select(c.alias("request"), F.when(c % 5 == 0, "sym1").when(c % 5 == 1, "SYM2").when(c % 5 == 2, "ETH").when(c % 5 == 3, hexed(c % 40, 40)).otherwise("none").alias("text"))
    return lookup.tokens(asked, registry).select("request", "code", "id")


@query("""SELECT c_custkey AS request, CASE WHEN c_custkey % 6 = 5 THEN 'TOKEN_UNKNOWN' WHEN a = b THEN 'SAME_TOKEN' WHEN b <> (a + 1) % 25 AND a <> (b + 1) % 25 THEN 'PAIR_UNKNOWN' END AS code,
CASE WHEN c_custkey % 6 <> 5 AND a <> b THEN CASE WHEN b = (a + 1) % 25 THEN a WHEN a = (b + 1) % 25 THEN b END END AS id
FROM (SELECT c_custkey, c_custkey % 25 AS a, (c_custkey % 25 + [1, 24, 0, 7, 1, 2][CAST(c_custkey % 6 AS INTEGER) + 1]) % 25 AS b FROM customer)""")
def pair_lookup(spark, d):
    """Pools by their two tokens, in either order, by symbol or address."""
    k, c = F.col("n_nationkey"), F.col("c_custkey")
    other = (k + 1) % 25
    registry = v.table(spark, d, "nation").select(k.alias("id"), hexed(k, 40).alias("token0"), hexed(other, 40).alias("token1"), F.concat(F.lit("S"), k).alias("symbol0"), F.concat(F.lit("S"), other).alias("symbol1"))
    a = c % 25
    b = (a + F.get(F.array(*map(F.lit, (1, 24, 0, 7, 1, 2))), (c % 6).cast("int"))) % 25
    asked = v.table(spark, d, "customer").select(c.alias("request"), F.concat(F.lit("s"), a).alias("a"), F.when(c % 6 == 5, "none").when(c % 6 == 1, hexed(b, 40)).otherwise(F.concat(F.lit("s"), b)).alias("b"))
    return lookup.pairs(asked, registry).select("request", "code", "id")


@query("""SELECT p_partkey AS leg, CASE WHEN p_size % 30 < 25 THEN p_size % 30 END AS feed, CASE WHEN p_size % 30 >= 25 THEN 'ORACLE_UNKNOWN' END AS code FROM part""")
def underlying_oracles(spark, d):
    """The oracle feed of each underlying asset."""
    feeds = v.table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("feed_id"), F.concat(F.lit("A"), "n_nationkey").alias("base_asset"), F.concat(F.lit("A"), (F.col("n_nationkey") + 1) % 25).alias("asset_symbol"))
    legs = v.table(spark, d, "part").select(F.col("p_partkey").alias("leg"), F.concat(F.lit("A"), F.col("p_size") % 30).alias("oracle_symbol"))
    return lookup.with_oracles(legs, feeds).select("leg", F.col("feed_id").cast("bigint").alias("feed"), "code")


@query("SELECT c_custkey AS request, CASE WHEN c_custkey % 30 < 25 THEN CASE c_custkey % 3 WHEN 2 THEN c_custkey % 30 % 5 ELSE c_custkey % 30 END END AS id, CASE WHEN c_custkey % 30 >= 25 THEN 'TOKEN_UNKNOWN' END AS code FROM customer")
def first_token_lookup(spark, d):
    """The first registry row of a token's id, address or symbol, for registries of one pool a token."""
    k, c = F.col("n_nationkey"), F.col("c_custkey")
    registry = v.table(spark, d, "nation").select(F.concat(F.lit("N"), F.lpad(k.cast("string"), 2, "0")).alias("id"), hexed(k, 40).alias("token_address"), F.concat(F.lit("sym"), k % 5).alias("token_symbol"), k.alias("place"))
    m = c % 30
    text = F.when(m >= 25, "none").when(c % 3 == 0, F.concat(F.lit("n"), F.lpad(m.cast("string"), 2, "0"))).when(c % 3 == 1, hexed(m, 40)).otherwise(F.concat(F.lit("SYM"), m % 5))
    return lookup.first_tokens(v.table(spark, d, "customer").select(c.alias("request"), text.alias("text")), registry, "place").select("request", F.col("place").alias("id"), "code")


# Scalar functions.


@query("""SELECT c_custkey, c_custkey % 3 = 0 AS address, c_custkey % 3 = 1 AS hash, ['BTC', 'ETH', 'USDT', 'zzz'][CAST(c_custkey % 4 AS INTEGER) + 1] AS token, ['BTC', 'x', 'USDT', 'zzz'][CAST(c_custkey % 4 AS INTEGER) + 1] AS own_token, 'k' || c_custkey || ':x:spot' AS scope, 'spot' AS market FROM customer""")
def names_and_scopes(spark, d):
    """Addresses and hashes, token keys by the given or one's own names, scope keys and their parts."""
    c = F.col("c_custkey")
    ref = F.when(c % 3 == 0, hexed(c, 40)).when(c % 3 == 1, hexed(c, 64)).otherwise(hexed(c, 41))
    token = F.get(F.array(*map(F.lit, (" Bitcoin", "ETHER", "tether ", "Zzz"))), (c % 4).cast("int"))
    scope = s.scope_key(F.concat(F.lit("k"), c), F.lit("x"), F.lit("spot"))
    return v.table(spark, d, "customer").select("c_custkey", s.is_address(ref).alias("address"), s.is_hash(ref).alias("hash"), s.token_key(token).alias("token"), s.token_key(token, {"bitcoin": "BTC", "ether": "x", "tether": "USDT"}).alias("own_token"), scope.alias("scope"), s.scope_parts(scope)["market"].alias("market"))


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_custkey * 1000 WHEN 1 THEN o_custkey * 60000 WHEN 2 THEN o_custkey * 3600000 WHEN 3 THEN o_custkey * 86400000 END AS ms, CASE WHEN o_orderkey % 3 <> 2 THEN o_orderdate END AS ts, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE 0 END AS idx,
CASE WHEN o_orderkey % 6 = 0 THEN 'ORDER' WHEN o_orderkey % 6 = 1 THEN 'FUTURE' WHEN o_orderkey % 6 = 2 THEN 'TOO_LONG' WHEN o_orderkey % 6 = 3 THEN 'TOO_OLD' ELSE 'ok' END AS code FROM orders""")
def times_and_ranges(spark, d):
    """intervals, times in digits or ISO text, ranges of days, indexes."""
    o, k = v.table(spark, d, "orders"), F.col("o_orderkey")
    unit = F.get(F.array(*map(F.lit, ("s", "m", "h", "d", "w"))), (k % 5).cast("int"))
    ts = F.col("o_orderdate").cast("timestamp")
    text = F.when(k % 3 == 0, F.unix_millis(ts).cast("string")).when(k % 3 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).otherwise("soon")
    today = F.lit("2024-06-01").cast("date")
    day = lambda x: F.lit(x).cast("date")
    first = F.when(k % 6 == 0, day("2024-03-02")).when(k % 6 == 2, day("2022-01-01")).when(k % 6 == 3, day("2014-05-31")).otherwise(day("2024-03-01"))
    last = F.when(k % 6 == 1, day("2024-06-02")).when(k % 6 == 2, day("2023-01-02")).when(k % 6 == 3, day("2014-06-01")).when(k % 6 == 4, day("2024-06-01")).otherwise(day("2024-03-01"))
    return o.select("o_orderkey", s.interval_ms(F.concat("o_custkey", unit)).alias("ms"), s.any_timestamp(text).alias("ts"), s.index_or_zero(F.when(k % 2 == 0, k.cast("string")).otherwise(F.concat(F.lit("call_"), k))).alias("idx"), s.range_code(first, last, today).alias("code"))


@query("SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_size ORDER BY p_retailprice, p_partkey) AS BIGINT) AS place FROM part")
def decimal_order(spark, d):
    """decimal strings in order of value."""
    from pyspark.sql.window import Window

    c = cents("p_retailprice")
    text = F.concat((c / 100).cast("bigint"), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"))
    by = Window.partitionBy("p_size").orderBy(s.price_order(text), "p_partkey")
    return v.table(spark, d, "part").select("p_partkey", F.row_number().over(by).cast("bigint").alias("place"))


@query("SELECT c_custkey, [1, 56, 8453, NULL, 42161][CAST(c_custkey % 5 AS INTEGER) + 1] AS chain_id FROM customer")
def chain_references(spark, d):
    """chains by id, name or another name."""
    c = F.col("c_custkey")
    asked = v.table(spark, d, "customer").select("c_custkey", F.get(F.array(*map(F.lit, ("1", " BNB-Smart-Chain", "base", "none", "arb"))), (c % 5).cast("int")).alias("reference"))
    return candles.resolve_chains(asked, candles.chains(spark)).select("c_custkey", F.col("chain_id").cast("int").alias("chain_id"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN ['0x' || lpad(lower(to_hex(p_partkey)), 40, '0'), '0x' || lpad(lower(to_hex(p_size)), 40, '0')] END AS addresses FROM part")
def abi_array_pairs(spark, d):
    """arrays of addresses and amounts; null where their lengths differ."""
    word = lambda x: F.lpad(F.lower(F.hex(x.cast("bigint"))), 64, "0")
    n = lambda x: word(F.lit(x))
    k = F.col("p_partkey")
    data = F.concat(F.lit("0x"), n(64), n(160), n(2), word(k), word(F.col("p_size")), F.when(k % 3 == 0, n(1)).otherwise(n(2)), word(k), word(k))
    return v.table(spark, d, "part").select("p_partkey", s.abi_arrays(data)["addresses"].alias("addresses"))


@query("SELECT p_brand AS network, count(*) AS n FROM part WHERE p_brand IN ('Brand#11', 'Brand#13') GROUP BY p_brand")
def allowed_networks(spark, d):
    """Pools on a list of networks."""
    return selection.on_networks(v.table(spark, d, "part").withColumnRenamed("p_brand", "network"), ["Brand#11", "Brand#13"]).groupBy("network").agg(F.count("*").alias("n"))


@query(f"SELECT l_suppkey, CAST(sum(CAST({_CENTS.format('l_extendedprice')} AS HUGEINT) * 100000000000000) AS VARCHAR) AS total FROM lineitem GROUP BY l_suppkey")
def exact_sums_in_sql(spark, d):
    """The exact sum as an aggregate of SQL."""
    u256.register(spark)
    rows = v.table(spark, d, "lineitem").select("l_suppkey", F.concat(cents("l_extendedprice"), F.lit("0" * 14)).alias("amount"))
    return spark.sql(f"SELECT l_suppkey, {u256.sql_sum('amount')} AS total FROM {{rows}} GROUP BY l_suppkey", rows=rows)
