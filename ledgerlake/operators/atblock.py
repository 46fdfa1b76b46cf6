"""Contract-call results at a block turned into prices and rates, for many blocks at once (survey 2.11)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from ledgerlake.functions import rational
from ledgerlake.functions import scalars as s
from ledgerlake.functions import u256
from ledgerlake.operators.identity import first_wins

AT = ["chain_id", "block"]
# Call selectors.
SELECTORS = {"balanceOf": "0x70a08231", "allowance": "0xdd62ed3e", "decimals": "0x313ce567", "name": "0x06fdde03", "symbol": "0x95d89b41", "totalSupply": "0x18160ddd", "latestRoundData": "0xfeaf968c", "slot0": "0x3850c7bd", "getReserves": "0x0902f1ac", "convertToAssets": "0x07a2d13a", "exchangeRateStored": "0x182df0f5", "stateSlot0": "0xc815641c"}
WORD_RATES = ("wsteth", "rocket-reth", "cbeth", "erc4626")
#: Adapters whose rate is sample * word / 10^k.
SCALED_RATES = {"aave-v2": 27, "aave-v3": 27, "compound-v2": 18}
STABLE = ("USDC", "USDT")
#: Calls and asked tokens that one task gathers.
TASK_CALLS = 200_000
# Pools and vaults that adapters call, by adapter and chain (0: any chain), and the selectors they use.
TARGETS = {("aave-v2", 0): "0x7d2768dE32b0b80b7a3454c06BdAc94A69DDc7A9", ("aave-v3", 1): "0x87870Bca3F3fD6335C3F4ce8392D69350B4fA4E2", ("aave-v3", 0): "0xA238Dd80C259a72e81d7e4664a9801593F98d1c5", ("curve-3pool-lp", 0): "0xbEbc44782C7dB0A1A60Cb6Fe97d0b483032FF1C7"}
RATE_SELECTORS = {"income": "0xd15e0053", "wsteth": "0x035faf82", "rocket-reth": "0xe6aa216c", "cbeth": "0x3ba0b9a9", "balances": "0x4903b0d1", "poolTokens": "0xf94d4668"}


def _wide_word(digits: Column) -> Column:
    """Hexadecimal digits of a decimal text of at most 78 digits; null from 2^256 on.

    Nine digits at a time are carried into words of 32 bits, the lowest first, so that no step leaves a long.
    """
    text = F.lpad(digits, 81, "0")
    chunks = F.array(*[F.substring(text, 9 * k + 1, 9).cast("bigint") for k in range(9)])

    def carried(words: Column, chunk: Column) -> Column:
        def step(at: Column, word: Column) -> Column:
            sum_ = word * F.lit(10**9) + at["carry"]
            return F.struct(F.shiftright(sum_, 32).alias("carry"), F.concat(at["done"], F.array(sum_.bitwiseAND(F.lit((1 << 32) - 1)))).alias("done"))

        return F.aggregate(words, F.struct(chunk.alias("carry"), F.array().cast("array<bigint>").alias("done")), step, lambda at: at["done"])

    zeros = F.array(*[F.lit(0).cast("bigint")] * 9)
    hexed = lambda words: F.when(F.get(words, 8) == 0, F.concat(*[F.lpad(F.lower(F.hex(F.get(words, k))), 8, "0") for k in range(7, -1, -1)]))
    return F.aggregate(chunks, zeros, carried, hexed)


def padded(value: Column) -> Column:
    """An address or number (of 256 bits at most) as an argument word."""
    wide = F.when(value.rlike("^[0-9]{19,78}$"), _wide_word(value))
    return F.lpad(F.when(value.startswith("0x"), F.lower(F.substring(value, 3, 64))).when(F.length(value) <= 18, F.lower(F.hex(value.try_cast("bigint")))).otherwise(wide), 64, "0")


def plan_calls(registry: DataFrame, selector: str, suffix: str, arguments: list[Column] | None = None) -> DataFrame:
    """call_id, target and call_data of one call for each row of a registry (id, target)."""
    data = F.concat(F.lit(SELECTORS[selector]), *[padded(a) for a in arguments or ()])
    return registry.select(F.concat_ws("::", "id", F.lit(suffix)).alias("call_id"), "target", data.alias("call_data"))


def plan_rates(tokens: DataFrame) -> DataFrame:
    """call_id (``<token_id>::<part>``), target and call_data of the calls that each DeFi token's adapter needs.

    tokens: token_id, chain_id, adapter, token_address, sample (decimal text), legs (array of addresses), adapter_target
    and adapter_pool_id (for vaults, null otherwise). A fixed ratio needs no call; a vault without target or a pool id
    of 64 hexadecimal digits, and an unknown adapter, give a row with a code instead.
    """
    kind, of = F.col("adapter"), lambda *names: F.col("adapter").isin(*names)
    own = F.col("token_address")
    fixed = lambda a: F.coalesce(*[F.when((kind == n) & ((F.col("chain_id") == c) if c else F.lit(True)), t) for (n, c), t in TARGETS.items() if n in a])
    call = lambda part, target, *data: F.struct(F.lit(part).alias("part"), target.alias("target"), F.concat(*data).alias("data"))
    rate, supply = F.create_map(*[F.lit(x) for kv in (RATE_SELECTORS | {"compound-v2": SELECTORS["exchangeRateStored"]}).items() for x in kv]), call("supply", own, F.lit(SELECTORS["totalSupply"]))
    vault = F.coalesce(F.col("adapter_target").isNotNull() & F.col("adapter_pool_id").rlike("^[0-9a-fA-F]{64}$"), F.lit(False))
    calls = (
        F.when(of("aave-v2", "aave-v3"), F.array(call("income", fixed(("aave-v2", "aave-v3")), rate["income"], padded(F.coalesce(F.get("legs", 0), own)))))
        .when(of("wsteth", "rocket-reth", "cbeth", "compound-v2"), F.array(call("rate", own, rate[kind])))
        .when(kind == "erc4626", F.array(call("assets", own, F.lit(SELECTORS["convertToAssets"]), padded(F.col("sample")))))
        .when(kind == "curve-3pool-lp", F.array(*[call(f"balance{k}", fixed(("curve-3pool-lp",)), rate["balances"], padded(F.lit(str(k)))) for k in range(3)], supply))
        .when(of("uniswap-v2-lp", "aerodrome-lp"), F.array(call("reserves", own, F.lit(SELECTORS["getReserves"])), supply))
        .when((kind == "balancer-bpt") & vault, F.array(call("poolTokens", F.col("adapter_target"), rate["poolTokens"], F.col("adapter_pool_id")), supply))
    )
    code = F.when(calls.isNull() & (kind == "balancer-bpt"), "ADAPTER_METADATA_INVALID").when(calls.isNull() & (kind != "fixed-ratio"), "ADAPTER_UNKNOWN")
    rows = tokens.select("token_id", "chain_id", code.alias("code"), F.explode_outer(calls).alias("c")).filter("c is not null or code is not null")
    return rows.select("chain_id", F.concat_ws("::", "token_id", F.col("c.part")).alias("call_id"), F.col("c.target").alias("target"), F.col("c.data").alias("call_data"), "code")


def plan_reads(reads: DataFrame) -> DataFrame:
    """Call data of ERC-20 reads: id, target, read (a name of SELECTORS), owner and spender where it takes them."""
    words = F.when(F.col("read").isin("balanceOf", "allowance"), padded(F.col("owner"))).otherwise("")
    more = F.when(F.col("read") == "allowance", padded(F.col("spender"))).otherwise("")
    names = F.create_map(*[F.lit(x) for k in ("balanceOf", "allowance", "decimals", "name", "symbol", "totalSupply") for x in (k, SELECTORS[k])])
    return reads.select("id", "target", "read", F.concat(F.try_element_at(names, "read"), words, more).alias("call_data"))


def with_results(plan: DataFrame, results: DataFrame, prefix: str) -> DataFrame:
    """The plan, with chain_id, block and call_id, beside success and return_data; a missing result has null success."""
    got = results.select(*AT, "call_id", F.col("success").alias(f"{prefix}_ok"), F.lower("return_data").alias(f"{prefix}_data"))
    return plan.join(got, [*AT, "call_id"], "left")


def call_code(ok: Column, data: Column) -> Column:
    return F.when(ok.isNull(), "RESPONSE_INVALID").when(~ok, "CALL_REVERTED").when(data == "0x", "NOT_DEPLOYED_AT_BLOCK")


def uint(data: Column) -> Column:
    """Decimal string of a single word, else null."""
    return F.when(s.has_words(data, 1), u256.hex_text(data))


def oracle_prices(feeds: DataFrame, results: DataFrame, blocks: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """Price or failure code of each asked feed and block, or of each feed at each block of its chain.

    asked: feed_id, chain_id, block; without it every pair is evaluated, which is meant for few feeds or blocks.

    feeds: feed_id, chain_id, expected_decimals, heartbeat (nullable); results: chain_id, block, call_id
    (``<feed_id>::round`` and ``::decimals``), success, return_data; blocks: chain_id, block, block_ts (seconds).
    """
    at = blocks.join(feeds, "chain_id") if asked is None else asked.select("feed_id", *AT).distinct().join(blocks, AT).join(feeds, ["feed_id", "chain_id"])
    told = results.select(*AT, F.regexp_extract("call_id", "^(.*)::(round|decimals)$", 1).alias("feed_id"), F.regexp_extract("call_id", "::(round|decimals)$", 1).alias("__part"), F.struct("success", F.lower("return_data").alias("data")).alias("__r")).filter("__part <> ''")
    both = told.groupBy(*AT, "feed_id").agg(*[F.max(F.when(F.col("__part") == p, F.col("__r"))).alias(f"__{p}") for p in ("round", "decimals")])
    rows = at.join(both, [*AT, "feed_id"], "left").select(*at.columns, *[F.col(f"__{p}.{c}").alias(f"{p}_{n}") for p in ("round", "decimals") for c, n in (("success", "ok"), ("data", "data"))])
    data = F.col("round_data")
    word = lambda k: s.word(data, k)
    rows = rows.withColumn("shaped", s.has_words(data, 5))
    rows = rows.select("*", F.when(F.col("shaped"), u256.signed_hex_text(word(1))).alias("raw_answer"), *[F.when(F.col("shaped"), s.word_long(data, k)).alias(n) for k, n in ((2, "started_at"), (3, "updated_at"))], *[F.when(F.col("shaped"), F.lpad(F.substring(data, 3 + 64 * k, 64), 64, "0")).alias(n) for k, n in ((0, "round_word"), (4, "answered_word"))], s.word_long(F.col("decimals_data"), 0).alias("decimals"))
    age = F.col("block_ts") - F.col("updated_at")
    code = (
        F.when(F.col("round_ok").isNull(), "FEED_RESPONSE_INVALID")
        .when(~F.col("round_ok"), "FEED_CALL_REVERTED")
        .when(data == "0x", "FEED_NOT_DEPLOYED_AT_BLOCK")
        .when(~F.col("shaped"), "FEED_RESPONSE_INVALID")
        .when(F.col("raw_answer").rlike("^(-|0$)") | (F.coalesce("updated_at", F.lit(1)) == 0), "FEED_ROUND_UNAVAILABLE")
        .when(F.coalesce((F.col("started_at") > F.col("updated_at")) | (F.col("updated_at") > F.col("block_ts")), F.lit(True)), "FEED_ANSWER_INVALID")
        .when(F.col("answered_word") < F.col("round_word"), "FEED_ANSWER_INVALID")
        .when(~F.coalesce("decimals_ok", F.lit(False)) | ~s.has_words(F.col("decimals_data"), 1), "FEED_RESPONSE_INVALID")
        .when(~F.coalesce(F.col("decimals") == F.col("expected_decimals"), F.lit(False)), "FEED_RESPONSE_INVALID")
    )
    rows = rows.withColumn("code", code)
    good = F.col("code").isNull()
    return rows.select("feed_id", *AT, "code", F.when(good, F.col("raw_answer")).alias("raw_answer"), F.when(good, s.fixed_point(F.col("raw_answer"), F.col("expected_decimals"))).alias("price"), F.when(good, age).alias("age_seconds"), F.when(good, age > F.col("heartbeat")).alias("is_stale"))


def exchange_rates(tokens: DataFrame, results: DataFrame) -> DataFrame:
    """Underlying amounts of a sample of each DeFi token at each block, or a failure code.

    tokens: token_id, adapter, sample (decimal string), legs (array of lower-case addresses), chain_id, block. results:
    call_id ``<token_id>::<part>`` where part is income, rate, assets, reserves, supply, balance0..2 or poolTokens.
    Decoding is in columns; only floor(a * b / c) beyond 128 bits is Arrow-batched. Any amount of zero is invalid.
    """
    key = [*AT, "token_id"]
    ident, part = (F.split_part("call_id", F.lit("::"), F.lit(k)) for k in (1, 2))
    calls = results.select(*AT, ident.alias("token_id"), F.struct(part.alias("part"), F.struct("success", F.lower("return_data").alias("data")).alias("told")).alias("call")).dropna(subset=key)
    asked = tokens.select(*key, F.struct("adapter", "sample", "legs").alias("token"))
    # both are dealt to as many tasks as their number asks for, in one shuffle: what a task gathers does not grow with them
    n = max(1, -(-(calls.count() + asked.count()) // TASK_CALLS))
    both = asked.unionByName(calls, allowMissingColumns=True).repartition(n, *key).groupBy(*key)
    told = both.agg(F.collect_list("token").alias("tokens"), F.map_from_entries(F.collect_list("call")).alias("calls"))
    rows = told.select(*key, "calls", F.explode("tokens").alias("token")).select(*key, "calls", "token.*")
    needs = {"aave-v2": ["income"], "aave-v3": ["income"], "compound-v2": ["rate"], "wsteth": ["rate"], "rocket-reth": ["rate"], "cbeth": ["rate"], "erc4626": ["assets"], "curve-3pool-lp": ["balance0", "balance1", "balance2", "supply"], "uniswap-v2-lp": ["reserves", "supply"], "aerodrome-lp": ["reserves", "supply"], "balancer-bpt": ["poolTokens", "supply"], "fixed-ratio": []}
    need = F.create_map(*[x for k, v in needs.items() for x in (F.lit(k), F.array(*map(F.lit, v)).cast("array<string>"))])
    call = lambda p: F.try_element_at("calls", p)
    wanted = F.try_element_at(need, "adapter")
    bad = F.filter(F.transform(wanted, lambda p: call_code(call(p)["success"], call(p)["data"])), lambda c: c.isNotNull())
    rows = rows.withColumn("code", F.when(wanted.isNull(), "ADAPTER_UNKNOWN").otherwise(F.get(bad, 0)))
    data = lambda p: call(F.lit(p))["data"]
    one = F.lit("1")
    num = lambda *xs: F.array(*xs)
    hexed = lambda w: u256.hex_text(w)
    kind = F.col("adapter")
    pool = s.abi_arrays(data("poolTokens"))
    rows = rows.withColumn("pool", F.when((kind == "balancer-bpt") & F.col("code").isNull(), pool))
    matched = F.transform("legs", lambda a: F.get(F.col("pool")["amounts"], F.array_position(F.col("pool")["addresses"], a).cast("int") - 1))
    factors = (
        F.when(kind == "fixed-ratio", F.transform("legs", lambda _: one))
        .when(kind.isin(*SCALED_RATES), num(uint(F.coalesce(data("income"), data("rate")))))
        .when(kind.isin(*WORD_RATES), num(uint(F.coalesce(data("rate"), data("assets")))))
        .when(kind == "curve-3pool-lp", num(*[uint(data(f"balance{k}")) for k in range(3)]))
        .when(kind == "balancer-bpt", F.transform(matched, hexed))
        .otherwise(F.when(s.has_words(data("reserves"), 3), num(hexed(s.word(data("reserves"), 0)), hexed(s.word(data("reserves"), 1)))))
    )
    divisor = F.when(kind.isin(*[k for k, v in SCALED_RATES.items() if v == 27]), "1" + "0" * 27).when(kind == "compound-v2", "1" + "0" * 18).when(kind.isin("fixed-ratio", *WORD_RATES), "1").otherwise(uint(data("supply")))
    scale = F.when(kind.isin(*WORD_RATES), "1").otherwise(F.col("sample"))
    flat = rows.select("token_id", *AT, "code", F.when(F.col("code").isNull(), factors).alias("factors"), divisor.alias("divisor"), scale.alias("scale"))
    rates = _floor_products(flat)
    return rates.withColumn("code", F.coalesce("code", F.when(F.col("amounts").isNull(), "RESPONSE_INVALID")))


def _floor_products(rows: DataFrame) -> DataFrame:
    """rows with amounts, floor(factor * scale / divisor) of each of its factors, instead of these columns.

    amounts is null where one would be zero or cannot be told, or there is none.
    """
    keep = [c for c in rows.columns if c not in ("factors", "scale", "divisor")]

    def products(factors: list[str | None] | None, scale: str | None, divisor: str | None) -> list[str] | None:
        if not factors or not all(factors) or not scale or not divisor or not int(divisor):
            return None
        amounts = [int(f) * int(scale) // int(divisor) for f in factors]
        return [str(a) for a in amounts] if all(amounts) else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = (b.column(c).to_pylist() for c in ("factors", "scale", "divisor"))
            amounts = [products(*x) for x in zip(*parts, strict=True)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(amounts, pa.list_(pa.string()))], [*keep, "amounts"])

    return rows.mapInArrow(work, rows.select(*keep).schema.add("amounts", ArrayType(StringType())))


def pool_prices(requests: DataFrame, results: DataFrame, words: int = 7) -> DataFrame:
    """Spot and tick price of pools at blocks. words: 7 for slot0 of a version-3 pool, 4 for a version-4 state view.

    requests: request, pool, base_is_0, decimals0, decimals1, chain_id, block; results: call_id is the pool. Many
    requests may name a pool; its state is decoded once a block and joined back.
    """
    states = first_wins(results.select(*AT, F.col("call_id").alias("pool"), "success", F.lower("return_data").alias("data")), [*AT, "pool"], ["success", "data"])
    data, key = F.col("data"), [*AT, "pool"]
    # each part is a column of its own: within one expression Spark would compute it anew wherever it is named
    states = states.select(*key, "success", "data", s.has_words(data, words).alias("shaped"))
    # a word stays hexadecimal: digits of equal number compare like the numbers, and only the arithmetic needs these
    states = states.select(*key, call_code(F.col("success"), data).alias("code"), *[F.when(F.col("shaped"), F.substring(data, lo, n)).alias(c) for c, lo, n in (("sqrt", 1, 66), ("pad", 67, 58), ("low", 125, 6), ("fee_words", 131, 128))])
    states = states.withColumn("low", F.conv("low", 16, 10).cast("int"))
    negative = F.col("low") >= 1 << 23
    states = states.withColumn("tick", F.when(F.col("pad") == F.when(negative, "f" * 58).otherwise("0" * 58), F.col("low") - F.when(negative, 1 << 24).otherwise(0)))
    states = states.select(*key, "code", "sqrt", F.when(F.col("tick").between(-s.MAX_TICK, s.MAX_TICK), F.col("tick")).alias("tick"), "fee_words")
    rows = requests.join(states, [*AT, "pool"], "left")
    fees = F.lit(True) if words != 4 else F.coalesce((F.col("fee_words").rlike("^(0{58}[0-9a-f]{6}){2}$")), F.lit(False))
    bad = ~fees | F.col("sqrt").isNull() | (F.col("sqrt") == "0x" + "0" * 64) | (F.col("sqrt") >= f"0x{10**49:064x}") | F.col("tick").isNull()
    rows = rows.withColumn("code", F.coalesce("code", F.when(bad, "RESPONSE_INVALID")))
    good, orient = F.col("code").isNull(), [F.col(c) for c in ("base_is_0", "decimals0", "decimals1")]
    spot, by_tick = rational.sqrt_price(F.when(good, F.col("sqrt")), *orient), rational.tick_price(F.when(good, F.col("tick")), *orient)
    return rows.select("request", "pool", *AT, "code", "tick", spot.alias("spot"), by_tick.alias("by_tick"))


def state_view_prices(requests: DataFrame, results: DataFrame) -> DataFrame:
    """Price and USD price of version-4 pools at blocks, from the four words of their state view.

    requests: those of :func:`pool_prices` and quote, the quote's symbol. The USD price is the spot price where the
    quote is a stable coin, and otherwise 0; a pool without a price has its code and no USD price.
    """
    rows = pool_prices(requests, results, 4).join(requests.select("request", "quote"), "request")
    usd = F.when(F.upper("quote").isin(*STABLE), F.col("spot.display")).otherwise("0")
    return rows.withColumn("price_usd", F.when(F.col("code").isNull(), usd))


def best_price(candidates: DataFrame, key: list[str]) -> DataFrame:
    """The highest of few candidate ratios (price: num, den, display; rank) of each key; equal ones go by rank."""
    ordered = candidates.filter("price.num is not null").withColumn("__at", rational.ratio_order("price.num", "price.den"))
    top = ordered.groupBy(*key).agg(F.max(F.struct("__at", (-F.col("rank")).alias("rank"), "price")).alias("t"))
    return top.select(*key, (-F.col("t.rank")).alias("rank"), F.col("t.price").alias("price"))


def token_prices_usd(prices: DataFrame, weth: str = "WETH") -> DataFrame:
    """USD price of tokens at blocks, from pool prices (token, quote, rank, price, chain_id, block).

    A stable quote counts as one dollar; a wrapped-native quote goes through its own best stable price at that block;
    the highest of a token's candidates wins. Tokens without one get the code PRICE_UNAVAILABLE.
    """
    good = prices.filter("price.num is not null")
    direct = good.filter(F.col("quote").isin(*STABLE)).select(*AT, "token", "rank", "price")
    reference = best_price(direct.filter(F.col("token") == weth), [*AT, "token"]).select(*AT, F.col("price").alias("eth"))
    hop = good.filter((F.col("quote") == weth) & (F.col("token") != weth)).join(reference, AT)
    through = hop.select(*AT, "token", "rank", rational.times("price.num", "price.den", "eth.num", "eth.den").alias("price"))
    best = best_price(direct.unionByName(through), [*AT, "token"])
    rows = prices.select(*AT, "token").distinct().join(best, [*AT, "token"], "left")
    return rows.select(*AT, "token", F.col("price.display").alias("price_usd"), F.when(F.col("price").isNull(), "PRICE_UNAVAILABLE").alias("code"))


def erc20_reads(results: DataFrame) -> DataFrame:
    """Decoded value of ERC-20 reads (read: a name of SELECTORS), or CALL_FAILED or DECODE_FAILED."""
    data, read = F.lower("return_data"), F.col("read")
    text = s.abi_text(data)
    small = s.token_decimals(uint(data))
    value = F.when(read.isin("name", "symbol"), text).when(read == "decimals", small.cast("string")).otherwise(uint(data))
    rows = results.withColumn("value", F.when(F.col("success"), value))
    return rows.withColumn("code", F.when(~F.col("success"), "CALL_FAILED").when(F.col("value").isNull(), "DECODE_FAILED"))


def balances_of(tokens: DataFrame, results: DataFrame) -> DataFrame:
    """Balance of asked tokens (chain_id, block, address, token_address); empty data is 0, a reverted call is left out."""
    rows = tokens.join(results.select(*AT, "address", "token_address", "success", F.lower("return_data").alias("data")), [*AT, "address", "token_address"], "left")
    kept = rows.filter(F.coalesce("success", F.lit(True)))
    return kept.select(*AT, "address", "token_address", F.when(F.coalesce("data", F.lit("0x")) == "0x", "0").otherwise(uint(F.col("data"))).alias("amount"))


def native_balances(results: DataFrame, blocks: DataFrame) -> DataFrame:
    got = results.select(*AT, "address", s.hex_to_decimal(F.lower("return_data")).alias("amount"))
    return got.join(blocks.select(*AT, "block_ts"), AT)


def consistent(results: DataFrame, headers: DataFrame) -> DataFrame:
    """Results of blocks whose header hash was the same before and after the calls."""
    same = headers.filter(F.col("hash_before") == F.col("hash_after")).select(*AT)
    return results.join(same, AT, "left_semi")


def decode_batch(data: str) -> list[tuple[bool, str]]:
    """(success, return data) of each call in an aggregate result; ValueError if an offset, flag or length is wrong."""
    raw = bytes.fromhex(data.removeprefix("0x"))

    def number(at: int) -> int:
        if at < 0 or at % 32 or at + 32 > len(raw):
            raise ValueError("truncated or misaligned")
        return int.from_bytes(raw[at : at + 32], "big")

    base = number(0)
    count, out = number(base), []
    if count * 32 > len(raw):
        raise ValueError("too many results")
    for k in range(count):
        head = number(base + 32 + 32 * k)
        start = base + 32 + head
        flag, offset = number(start), number(start + 32)
        if head < 32 * count or flag > 1 or offset != 64:
            raise ValueError("malformed tuple")
        size, begin = number(start + 64), start + 96
        if begin + size > len(raw):
            raise ValueError("truncated bytes")
        out.append((flag == 1, "0x" + raw[begin : begin + size].hex()))
    return out


def decode_batches(blobs: DataFrame) -> DataFrame:
    """A row for each call of every blob (batch_id, expected, data): call_index, success, return_data; or one with a code."""
    kind = blobs.schema["batch_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for b in batch.to_pylist():
                try:
                    got = decode_batch(b["data"])
                    if len(got) != b["expected"]:
                        raise ValueError("another number of results")
                    rows += [(b["batch_id"], k, ok, d, None) for k, (ok, d) in enumerate(got)]
                except (ValueError, AttributeError, TypeError):
                    rows.append((b["batch_id"], None, None, None, "RESPONSE_INVALID"))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (batch.schema.field("batch_id").type, pa.int32(), pa.bool_(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["batch_id", "call_index", "success", "return_data", "code"])

    return blobs.select("batch_id", "expected", "data").mapInArrow(work, f"batch_id {kind}, call_index int, success boolean, return_data string, code string")


def valued(balances: DataFrame, prices: DataFrame) -> DataFrame:
    """Balances (token_address, decimals, amount, chain_id, block) with the price of each token at the block, as text."""
    return balances.join(prices.select(*AT, "token_address", "price"), [*AT, "token_address"], "left").withColumn("quantity", s.fixed_point(F.col("amount"), F.col("decimals")))
