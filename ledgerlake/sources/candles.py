"""Candle arrays of several exchanges as price points (survey S12-S16), and registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import scalars as s

#: Place of each field in a source's candle array, and what its first field counts.
LAYOUTS = {
    "a": ({"open": 1, "high": 2, "low": 3, "close": 4, "volume": 5}, "ms"),
    "b": ({"open": 1, "high": 2, "low": 3, "close": 4, "volume": 5, "confirm": 8}, "ms"),
    "c": ({"low": 1, "high": 2, "open": 3, "close": 4, "volume": 5}, "s"),
    "dex": ({"open": 1, "high": 2, "low": 3, "close": 4, "volume": 5}, "s"),
    "d": ({"volume": 1, "close": 2}, "s"),
}
PATHS = {"a": "", "b": "data", "c": "", "dex": "data.attributes.ohlcv_list", "d": ""}


def register(layout: str, places: dict[str, int], unit: str, path: str = "") -> None:
    """A candle layout of one's own: the place of each field (close at least), "ms" or "s", and the JSON path of the rows."""
    if "close" not in places or unit not in ("ms", "s"):
        raise ValueError("a layout has the place of close, and its first field counts ms or s")
    LAYOUTS[layout], PATHS[layout] = (places, unit), path


def candles(bodies: DataFrame, layout: str) -> DataFrame:
    """Price points of bodies (scope columns, body): ts, day, fields as decimal strings, is_final where told, ordinal.

    Fields that are no decimal number are null; rows without a time or close are left out.
    """
    places, unit = LAYOUTS[layout]
    text = F.get_json_object("body", "$." + PATHS[layout]) if PATHS[layout] else F.col("body")
    scope = [c for c in bodies.columns if c != "body"]
    rows = bodies.select(*scope, F.posexplode(F.from_json(text, "array<array<string>>")).alias("ordinal", "c"))
    stamp = F.get("c", 0).try_cast("double").cast("bigint")
    ts = F.timestamp_millis(stamp) if unit == "ms" else F.timestamp_seconds(stamp)
    field = lambda k: F.when(s.is_price(F.get("c", k)), F.get("c", k))
    out = rows.select(*scope, "ordinal", ts.alias("ts"), F.to_date(ts).alias("day"), *[field(k).alias(n) for n, k in places.items() if n != "confirm"], *([(F.get("c", places["confirm"]) == "1").alias("is_final")] if "confirm" in places else []))
    return out.withColumn("price", F.col("close").try_cast("decimal(38,18)")).filter("ts is not null and price is not null and price > 0")


def _repeated(rows: DataFrame, key: list, fault: str, name: str) -> DataFrame:
    """name of rows whose key others have as well, with the fault."""
    twice = rows.groupBy(*[k.alias(f"__{i}") for i, k in enumerate(key)]).agg(F.collect_set(name).alias("__names"), F.count("*").alias("__n")).filter("__n > 1")
    return twice.select(F.explode("__names").alias(name), F.lit(fault).alias("fault"))


def is_standard_feed() -> Column:
    """Crypto reference price in USD, without a second proxy, neither hidden nor to be shut down (of raw feed metadata)."""
    d = lambda c: F.col(f"docs.{c}")
    kind = (d("productTypeCode") == "RefPrice") & (d("quoteAsset") == "USD") & (d("assetClass") == "Crypto")
    return F.coalesce(kind, F.lit(False)) & F.col("secondaryProxyAddress").isNull() & ~F.coalesce(d("hidden"), F.lit(False)) & d("shutdownDate").isNull()


def standard_feeds(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Standard oracle feeds as a dimension, in order of id, and the faults of their metadata; with a fault none is to be used.

    raw: name, path, proxyAddress, secondaryProxyAddress, assetName, heartbeat, decimals, docs (productTypeCode,
    assetClass, quoteAsset, baseAsset, hidden, shutdownDate). Faults (path, fault) are PATH, ADDRESS, DECIMALS or SYMBOL
    of a feed, and DUPLICATE_ID, DUPLICATE_PROXY or DUPLICATE_NAME. Pass both to :func:`selection.checked` to fail closed.
    """
    chosen = raw.filter(is_standard_feed())
    text = lambda c: F.when(c != "", c)
    symbol = F.trim(F.split_part(F.coalesce("name", F.lit("")), F.lit(" / "), F.lit(1)))
    rows = chosen.select(F.col("path").alias("path"), F.coalesce("name", F.lit("")).alias("name"), F.col("proxyAddress").alias("proxy"), symbol.alias("asset_symbol"), text(F.col("assetName")).alias("asset_name"), F.coalesce(text(F.col("docs.baseAsset")), F.upper(symbol)).alias("base_asset"), F.col("decimals").alias("decimals"), F.when(F.col("heartbeat") >= 0, F.col("heartbeat").cast("bigint")).alias("heartbeat"))
    why = F.when(F.coalesce(F.col("path"), F.lit("")) == "", "PATH").when(~s.is_address(F.lower("proxy")), "ADDRESS").when(~F.coalesce(F.col("decimals").between(0, 255) & (F.col("decimals") == F.floor("decimals")), F.lit(False)), "DECIMALS").when(F.col("asset_symbol") == "", "SYMBOL")
    faults = rows.select("path", why.alias("fault")).filter("fault is not null")
    for key, fault in ((F.col("path"), "DUPLICATE_ID"), (F.lower("proxy"), "DUPLICATE_PROXY"), (F.col("name"), "DUPLICATE_NAME")):
        faults = faults.unionByName(_repeated(rows, [key], fault, "path"))
    feeds = rows.select(F.concat(F.lit("ethereum-mainnet:"), "path").alias("feed_id"), F.lit(1).cast("bigint").alias("chain_id"), "proxy", "asset_symbol", "asset_name", "base_asset", F.lit("USD").alias("quote_asset"), F.col("decimals").cast("int").alias("expected_decimals"), "heartbeat", F.col("path").alias("source_path"))
    return feeds.orderBy("feed_id"), faults


def pool_candidates(raw: DataFrame, quotes: list[str] | None = None, most: int | None = None) -> DataFrame:
    """The first ``most`` candidates by token address and symbol that have a valid address and an allowed quote symbol.

    raw: token_address, symbol, quote_symbol and more. Quote symbols are compared without regard to case.
    """
    rows = raw.filter(s.is_address(F.lower("token_address")) & F.col("symbol").isNotNull())
    if quotes is not None:
        rows = rows.filter(F.lower("quote_symbol").isin([q.lower() for q in quotes]))
    rows = rows.orderBy(F.lower("token_address"), "symbol")
    return rows if most is None else rows.limit(most)


def pool_identity() -> list[Column]:
    """What tells pool entries apart: pool, token, quote token and fee."""
    return [F.lower("pool_address"), F.lower("token_address"), F.lower("quote_token"), F.col("fee")]


def manifest(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pool entries in order of id, and those that share their identity with others (id, fault)."""
    return entries.orderBy("id"), _repeated(entries, pool_identity(), "DUPLICATE_POOL", "id")


def registry_faults(registry: DataFrame) -> DataFrame:
    """id and fault of rows that break the pool registry's rules; empty if it keeps them.

    registry: id, token_address, pool_address, token0, token1, quote_token, fee, decimals0, decimals1, deployment_block
    (text). The first that applies of ID, ADDRESS (any of the five), SIDES (the token is one of two different ones),
    QUOTE (the quote is the other one) and METADATA (fee, decimals, block), and DUPLICATE_ID and DUPLICATE_POOL. A
    missing value breaks its rule.
    """
    c, no = F.col, lambda rule: ~F.coalesce(rule, F.lit(False))
    valid = F.lit(True)
    for name in ("token_address", "pool_address", "token0", "token1", "quote_token"):
        valid = valid & s.is_address(c(name))
    sides = (c("token0") != c("token1")) & ((c("token_address") == c("token0")) | (c("token_address") == c("token1")))
    other = F.when(c("token_address") == c("token0"), c("token1")).otherwise(c("token0"))
    numbers = c("fee").between(1, 1_000_000) & c("decimals0").between(0, 255) & c("decimals1").between(0, 255) & c("deployment_block").rlike("^[0-9]+$")
    fault = F.when(no(c("id").rlike("^ethereum:uniswap-v3:[a-z0-9-]+$")), "ID").when(no(valid), "ADDRESS").when(no(sides), "SIDES").when(no(c("quote_token") == other), "QUOTE").when(no(numbers), "METADATA")
    found = registry.select("id", fault.alias("fault")).filter("fault is not null")
    return found.unionByName(_repeated(registry, [c("id")], "DUPLICATE_ID", "id")).unionByName(_repeated(registry, pool_identity(), "DUPLICATE_POOL", "id"))


def to_jdbc(facts: DataFrame, url: str, table: str) -> None:
    """Exports facts to a database; its driver must be on the class path."""
    facts.write.format("jdbc").option("url", url).option("dbtable", table).mode("append").save()


def from_jdbc(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int, parts: int) -> DataFrame:
    """Imports a table in ``parts`` ranges of a numeric column, read side by side."""
    return spark.read.format("jdbc").option("url", url).option("dbtable", table).option("partitionColumn", column).option("lowerBound", lower).option("upperBound", upper).option("numPartitions", parts).load()


# Chains, their other names, and native currency.
CHAINS = (
    (1, "ethereum", ("eth",), "ETH", 18),
    (56, "bsc", ("bnb-smart-chain",), "BNB", 18),
    (137, "polygon", (), "POL", 18),
    (42161, "arbitrum", ("arb",), "ETH", 18),
    (8453, "base", (), "ETH", 18),
    (10, "optimism", ("op",), "ETH", 18),
)


def chains(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, n, list(a), s_, d) for i, n, a, s_, d in CHAINS], "chain_id bigint, name string, aliases array<string>, symbol string, decimals int")


def resolve_chains(requests: DataFrame, dim: DataFrame) -> DataFrame:
    """chain_id of each request's reference: an id, its digits, a name or another name; null if unknown."""
    names = dim.select("chain_id", F.explode(F.concat(F.array("name", F.col("chain_id").cast("string")), "aliases")).alias("ref"))
    return requests.withColumn("ref", F.lower(F.trim("reference"))).join(names, "ref", "left").drop("ref")
