"""Registry lookups of many requests at once: tokens, pairs, and the oracles of underlying assets (survey J2, J3, J14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.scalars import is_address

# Symbols under which wrapped assets are asked for.
SYMBOL_ALIASES = {"eth": "weth", "btc": "wbtc", "avax": "wavax", "tao": "wtao"}


def _asked(requests: DataFrame, column: str, aliases: dict[str, str]) -> DataFrame:
    low = F.lower(column)
    known = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv]) if aliases else None
    return requests.withColumn("__ref", low if known is None else F.coalesce(F.try_element_at(known, low), low))


def _names(registry: DataFrame, *columns: str) -> Column:
    return F.explode(F.array_distinct(F.array(*[F.lower(c) for c in columns])))


def tokens(requests: DataFrame, registry: DataFrame, aliases: dict[str, str] = SYMBOL_ALIASES) -> DataFrame:
    """Every registry row of each request's token, or one row with a code.

    requests: request, text (a symbol, another name of one, or an address); registry: id, token_address, token_symbol
    and more. Codes: TOKEN_UNKNOWN, and TOKEN_AMBIGUOUS where a symbol stands for several addresses.
    """
    rows = registry.withColumn("__ref", _names(registry, "token_address", "token_symbol"))
    found = _asked(requests, "text", aliases).join(rows, "__ref", "left")
    several = found.groupBy("request").agg(F.countDistinct(F.lower("token_address")).alias("__n"), F.first("__ref").alias("__ref"))
    bad = several.withColumn("code", F.when(F.col("__n") == 0, "TOKEN_UNKNOWN").when((F.col("__n") > 1) & ~is_address(F.col("__ref")), "TOKEN_AMBIGUOUS")).filter("code is not null").select("request", "code")
    good = found.join(bad, "request", "left_anti").drop("__ref")
    return good.withColumn("code", F.lit(None).cast("string")).unionByName(bad, allowMissingColumns=True)


def first_tokens(requests: DataFrame, registry: DataFrame, order: str = "id") -> DataFrame:
    """The first registry row, by ``order``, whose id, symbol or address is asked for; code TOKEN_UNKNOWN without one."""
    rows = registry.withColumn("__ref", _names(registry, "id", "token_address", "token_symbol"))
    best = rows.groupBy("__ref").agg(F.min(F.struct(order, *[c for c in registry.columns if c != order])).alias("__row"))
    found = _asked(requests, "text", {}).join(best, "__ref", "left")
    return found.select(*requests.columns, *[F.col(f"__row.`{c}`").alias(c) for c in registry.columns], F.when(F.col("__row").isNull(), "TOKEN_UNKNOWN").alias("code"))


def pairs(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Every registry row whose two tokens are a request's, in either order, or one row with a code.

    requests: request, a, b (symbols or addresses); registry: id, token0, token1, symbol0, symbol1 and more. Codes:
    TOKEN_UNKNOWN, TOKEN_AMBIGUOUS, SAME_TOKEN, and PAIR_UNKNOWN where no row has both. Of two tokens with a
    code, the first tells. An address stands for itself.
    """
    side = lambda k: registry.select(F.lower(f"symbol{k}").alias("__ref"), F.lower(f"token{k}").alias("__at"))
    named = side(0).unionByName(side(1)).groupBy("__ref").agg(F.min("__at").alias("__at"), F.countDistinct("__at").alias("__n"))
    asked = requests.select("request", F.posexplode(F.array(F.lower("a"), F.lower("b"))).alias("__side", "__ref")).join(named, "__ref", "left")
    at = F.when(is_address(F.col("__ref")), F.col("__ref")).when(F.col("__n") == 1, F.col("__at"))
    why = F.when(at.isNotNull(), None).when(F.col("__n") > 1, "TOKEN_AMBIGUOUS").otherwise("TOKEN_UNKNOWN")
    both = asked.groupBy("request").agg(F.array_sort(F.collect_set(at)).alias("__pair"), F.min(F.when(why.isNotNull(), F.struct("__side", why.alias("code"))))["code"].alias("code"))
    both = both.withColumn("code", F.coalesce("code", F.when(F.size("__pair") != 2, "SAME_TOKEN")))
    rows = registry.withColumn("__pair", F.array_sort(F.array(F.lower("token0"), F.lower("token1"))))
    found = both.filter("code is null").drop("code").join(rows, "__pair", "left").drop("__pair")
    found = found.withColumn("code", F.when(F.col("id").isNull(), "PAIR_UNKNOWN"))
    return found.unionByName(both.filter("code is not null").drop("__pair"), allowMissingColumns=True)


def with_oracles(legs: DataFrame, feeds: DataFrame) -> DataFrame:
    """Underlying assets (oracle_symbol and more) beside feed_id of the feed for that symbol, base asset before name.

    feeds: feed_id, base_asset, asset_symbol. Legs without a feed get the code ORACLE_UNKNOWN.
    """
    ranked = feeds.select("feed_id", F.posexplode(F.array("base_asset", "asset_symbol")).alias("__rank", "oracle_symbol"))
    best = ranked.groupBy("oracle_symbol").agg(F.min(F.struct("__rank", "feed_id")).alias("__best"))
    rows = legs.join(best, "oracle_symbol", "left").withColumn("feed_id", F.col("__best.feed_id")).drop("__best")
    return rows.withColumn("code", F.when(F.col("feed_id").isNull(), "ORACLE_UNKNOWN"))
