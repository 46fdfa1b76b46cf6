import json
from datetime import datetime

from pyspark.sql import functions as F

from ledgerlake.functions import rational
from ledgerlake.operators import atblock, prices
from ledgerlake.sources import candles, payloads

W = lambda n: format(n % 2**256, "064x")


def test_as_of(spark):
    pts = spark.createDataFrame([("t", datetime(2024, 1, 1, 0, 0), 10), ("t", datetime(2024, 1, 1, 0, 10), 12)], "k string, ts timestamp, price int")
    ask = spark.createDataFrame([("t", datetime(2024, 1, 1, 0, 5), 1), ("t", datetime(2024, 1, 1, 0, 10), 2), ("u", datetime(2024, 1, 1), 3)], "k string, ts timestamp, r int")
    near = {r.r: r.point.price if r.point else None for r in prices.as_of(ask, pts, ["k"]).collect()}
    assert near == {1: 10, 2: 12, 3: None}
    far = {r.r: r.point for r in prices.as_of(ask, pts, ["k"], max_distance_ms=1000).collect()}
    assert far[1] is None and far[2].price == 12
    assert {r.r: r.point.price if r.point else None for r in prices.as_of(ask, pts, ["k"], "after").collect()} == {1: 12, 2: 12, 3: None}


def test_distances_are_between_rounded_milliseconds(spark):
    at = lambda us: datetime(2024, 1, 1, 7, 35, us // 10**6, us % 10**6)
    pts = spark.createDataFrame([("t", at(6_870_520), 1), ("t", at(31_015_644), 2)], "k string, ts timestamp, price int")
    # by floors 12,073 and 12,072 ms; rounded 12,072 and 12,073
    assert [r.point.price for r in prices.as_of(spark.createDataFrame([("t", at(18_943_184))], "k string, ts timestamp"), pts, ["k"]).collect()] == [1]


def test_tick_prices():
    assert rational.sqrt_at_tick(0) == 2**96
    assert rational.sqrt_at_tick(-887272) == 4295128739
    assert rational.sqrt_at_tick(887272) == 1461446703485210103287273052203988822378723970342
    assert rational.scaled(1, 3) == "0." + "3" * 18


def test_pool_and_token_prices(spark):
    sqrt = 2**96 * 2000
    data = "0x" + W(sqrt) + W(-1) + W(0) * 5
    res = spark.createDataFrame([(1, 5, "p", True, data), (1, 5, "q", True, "0x12"), (1, 5, "r", False, "0x")], "chain_id bigint, block bigint, call_id string, success boolean, return_data string")
    ask = spark.createDataFrame([(k, p, True, 18, 6, 1, 5) for k, p in enumerate("pqrs")], "request int, pool string, base_is_0 boolean, decimals0 int, decimals1 int, chain_id bigint, block bigint")
    got = {r.pool: r for r in atblock.pool_prices(ask, res).collect()}
    assert got["p"].tick == -1 and got["p"].spot.display == "4000000000000000000"
    assert [got[p].code for p in "qrs"] == ["RESPONSE_INVALID", "CALL_REVERTED", "RESPONSE_INVALID"]
    one = lambda n: (str(n), "1", str(n))
    rows = [(1, 5, "WETH", "USDC", 0, one(1990)), (1, 5, "WETH", "USDT", 1, one(2000)), (1, 5, "T", "WETH", 0, one(3)), (1, 5, "T", "USDC", 1, one(5000)), (1, 5, "U", "DAI", 0, one(1))]
    p = spark.createDataFrame(rows, "chain_id bigint, block bigint, token string, quote string, rank int, price struct<num:string,den:string,display:string>")
    usd = {r.token: (r.price_usd, r.code) for r in atblock.token_prices_usd(p).collect()}
    assert usd == {"WETH": ("2000", None), "T": ("6000", None), "U": (None, "PRICE_UNAVAILABLE")}


def test_numbers_of_256_bits_as_words(spark):
    whole = [0, 7, 10**18 - 1, 10**18, 2**64, 2**120, 10**31, 10**32, 12345 * 10**27, 10**37 + 1, 2**128 - 1, 10**40, 2**255 + 2**31, 2**256 - 1]
    rows = spark.createDataFrame([(str(n),) for n in [*whole, 2**256, "1" * 79, "x" * 20]], "n string")
    got = {r.n: r.w for r in rows.select("n", atblock.padded(F.col("n")).alias("w")).collect()}
    assert got == {str(n): W(n) for n in whole} | {str(2**256): None, "1" * 79: None, "x" * 20: None}


def test_exchange_rates(spark):
    calls = {
        "lp": {"reserves": W(10) + W(20) + W(0), "supply": W(2 * 10**18)},
        "curve": {"balance0": W(10), "balance1": W(20), "balance2": W(30), "supply": W(2 * 10**18)},
        "aave": {"income": W(105 * 10**25)},
        "bal": {"poolTokens": W(96) + W(192) + W(0) + W(2) + W(0xBB) + W(0xAA) + W(2) + W(20) + W(10), "supply": W(2 * 10**18)},
        "bad": {"rate": W(0)},
        "gone": {"rate": ""},
    }
    tokens = [("lp", "uniswap-v2-lp", 10**18, 2), ("curve", "curve-3pool-lp", 10**18, 3), ("aave", "aave-v3", 10**6, 1), ("bal", "balancer-bpt", 10**18, 2), ("bad", "cbeth", 1, 1), ("gone", "cbeth", 1, 1), ("fixed", "fixed-ratio", 7, 1)]
    legs = ["0x" + format(n, "040x") for n in (0xAA, 0xBB, 0xCC)]
    t = spark.createDataFrame([(i, a, str(n), legs[:k], 1, 5) for i, a, n, k in tokens], "token_id string, adapter string, sample string, legs array<string>, chain_id bigint, block bigint")
    r = spark.createDataFrame([(1, 5, f"{i}::{p}", True, "0x" + d) for i, ps in calls.items() for p, d in ps.items()], "chain_id bigint, block bigint, call_id string, success boolean, return_data string")
    got = {x.token_id: (x.amounts, x.code) for x in atblock.exchange_rates(t, r).collect()}
    assert got["lp"] == (["5", "10"], None) and got["curve"] == (["5", "10", "15"], None) and got["aave"] == (["1050000"], None)
    assert got["bal"] == (["5", "10"], None) and got["bad"] == (None, "RESPONSE_INVALID") and got["gone"] == (None, "NOT_DEPLOYED_AT_BLOCK") and got["fixed"] == (["7"], None)


def test_batches(spark):
    good = "0x" + W(32) + W(2) + W(64) + W(192) + W(1) + W(64) + W(32) + W(7) + W(0) + W(64) + W(0)
    b = spark.createDataFrame([(1, 2, good), (2, 1, good), (3, 2, good[:-64]), (4, 0, "0x"), (5, 2, None)], "batch_id int, expected int, data string")
    rows = atblock.decode_batches(b).collect()
    assert [(r.call_index, r.success, r.return_data) for r in rows if r.batch_id == 1] == [(0, True, "0x" + W(7)), (1, False, "0x")]
    assert all(r.code == "RESPONSE_INVALID" for r in rows if r.batch_id != 1) and len(rows) == 6


def test_explorer_rows(spark):
    tx = {"blockNumber": "00000123", "timeStamp": "1700000000", "hash": "0xAB", "from": "0xF", "to": "", "value": "0001000", "isError": "0", "extraFutureField": 1}
    body = lambda s, m, r: json.dumps({"status": s, "message": m, "result": r})
    raw = spark.createDataFrame([(1, body("1", "OK", [tx])), (1, body("0", "No transactions found", [])), (1, body("0", "NOTOK", "Invalid API Key")), (1, "{")], "chain_id bigint, body string")
    r = payloads.normalise("explorer", "transactions", raw, "e").collect()
    assert [(x.block_number, x.block, x.value, x.tx_hash, x.to_address, x.status) for x in r] == [("123", 123, "1000", "0xab", None, "success")]
    assert [x.outcome for x in payloads.triage(raw).collect()] == ["ok", "empty", "error", "malformed"]


def test_rpc_and_context(spark):
    t = {"result": {"transfers": [{"category": "erc20", "uniqueId": "0xabc:log:1", "hash": "0xabc", "blockNum": "0x2a", "rawContract": {"address": "0xT", "value": "0x63", "decimal": "0x12"}, "metadata": {"blockTimestamp": "2024-01-01T00:00:00.000Z"}}]}}
    r = payloads.normalise("rpc", "transfers", spark.createDataFrame([(1, json.dumps(t))], "chain_id bigint, body string"), "r").first()
    assert (r.log_index, r.block, r.amount, r.token_decimals, r.ts) == ("1", 42, "99", 18, datetime(2024, 1, 1))
    c = {"hash": "0xA", "block_number": "7", "gas_price": "100", "receipt_gas_used": "21000", "logs": [{"log_index": "0", "transaction_hash": "0xa", "topic0": "t", "topic1": ""}, {"log_index": "1", "transaction_hash": "0xb"}]}
    heads, logs, wrong = payloads.contexts(spark.createDataFrame([(1, json.dumps(c))], "chain_id bigint, body string"))
    assert heads.first().gas_fee == "2100000" and logs.first().topics == ["t"] and wrong.count() == 1


def test_candles(spark):
    ms = 1782864000000
    rows = {"a": json.dumps([[ms, "1", "2", "0.5", "1.5", "100"]]), "b": json.dumps({"data": [[str(ms), "1", "2", "0.5", "1.5", "100", "", "", "1"]]}), "c": json.dumps([[ms // 1000, 0.5, 2, 1, 1.5, 100]]), "dex": json.dumps({"data": {"attributes": {"ohlcv_list": [[ms // 1000, 1, 2, 0.5, 1.5, 100]]}}}), "d": json.dumps([[str(ms // 1000), "100", "1.5", "2", "0.5", "1"]])}
    for layout, body in rows.items():
        r = candles.candles(spark.createDataFrame([("t", body)], "token_key string, body string"), layout).first()
        assert (str(r.day), r.close, r.volume) == ("2026-07-01", "1.5", "100"), layout


def test_chains_and_pools(spark):
    dim = candles.chains(spark)
    ask = spark.createDataFrame([("eth",), ("8453",), (" Polygon ",), ("none",)], "reference string")
    assert [r.chain_id for r in candles.resolve_chains(ask, dim).orderBy("reference").collect()] == [137, 8453, 1, None]
    tokens = spark.createDataFrame([("1", "PEPE", "Pepe", "0x1"), ("2", "PEPE2", "Other", "0x2")], "token_id string, symbol string, name string, token_address string")
    pools = spark.createDataFrame([("p", 5.0, 1.0, "1", "2"), ("q", 9.0, 1.0, "2", "1")], "pool_address string, liquidity double, volume double, base_id string, quote_id string")
    found = prices.match_pools(pools, tokens, spark.createDataFrame([("r", "pepe")], "request string, text string"))
    best = prices.best_pool(found).first()
    assert (best.pool_address, best.ambiguous) == ("q", False)
    at = lambda n: "0x" + format(n, "040x")
    rows = [(1, 10, 1, 2, 2, 500), (2, 10, 1, 2, 2, 500), (3, 11, 1, 1, 1, 500), (4, 12, 3, 1, 2, 500), (5, 13, 1, 1, 2, 0), (6, 14, 1, 2, 1, 500), (7, 15, 1, 2, 2, 1), (7, 16, 2, 1, 1, 1)]
    made = [(f"ethereum:uniswap-v3:{i}", at(t), at(p), at(a), at(b), at(q), fee, 18, 6, "1") for i, p, t, a, q, fee in [(i, p, t, a, q, f) for i, p, t, a, q, f in rows] for b in (2 if a == 1 and t != 1 or a == 1 and i != 3 else 1,)]
    made += [("Bad Id", *made[0][1:]), ("ethereum:uniswap-v3:8", "0x12", *made[0][2:])]
    registry = spark.createDataFrame(made, "id string, token_address string, pool_address string, token0 string, token1 string, quote_token string, fee int, decimals0 int, decimals1 int, deployment_block string")
    faults = {}
    for r in candles.registry_faults(registry).collect():
        faults.setdefault(r.id.rsplit(":", 1)[-1], set()).add(r.fault)
    assert faults["1"] == faults["2"] == {"DUPLICATE_POOL"} and faults["8"] == {"ADDRESS"} and "ID" in faults["Bad Id"]
    assert "SIDES" in faults["3"] and "SIDES" in faults["4"] and "METADATA" in faults["5"] and "DUPLICATE_ID" in faults["7"]
    assert {r.status for r in prices.request_summary(found.withColumn("code", F.lit(None).cast("string"))).collect()} == {"ok"}


def test_as_of_carries_points_between_buckets(spark):
    """Against a search of all points, for one key in many buckets, empty ones and ties included."""
    import random

    from ledgerlake.operators.asof import as_of

    rng = random.Random(4)
    pts = [(k, rng.randrange(0, 3000), rng.randrange(9)) for k in "ab" for _ in range(40)] + [("a", 10**6, 1)]
    ask = [(k, rng.randrange(-50, 4000), i) for i, k in enumerate("ab" * 100 + "c")]
    points = spark.createDataFrame(pts, "k string, at bigint, v int")
    probes = spark.createDataFrame(ask, "k string, at bigint, r int")
    for mode, far in (("before", None), ("after", None), ("nearest", None), ("nearest", 20)):
        got = {r.r: (r.point.at, r.point.v) if r.point else None for r in as_of(probes, points, ["k"], mode, far, "at", F.col("at"), 100, 1).collect()}
        for k, at, r in ask:
            before = max(((p, v) for q, p, v in pts if q == k and p <= at), default=None)
            after = max(((p, v) for q, p, v in pts if q == k and p == min((x for y, x, _ in pts if y == k and x >= at), default=None)), default=None)
            best = before if mode == "before" else after if mode == "after" else before if after is None or before and at - before[0] <= after[0] - at else after
            if far is not None and best and abs(best[0] - at) > far:
                best = None
            assert got[r] == best, (mode, k, at)


def test_gas_fee_beyond_one_decimal(spark):
    from ledgerlake.functions import scalars as s

    rows = spark.createDataFrame([("21000", "1" + "0" * 22), ("9" * 40, "7" * 40), (None, "1"), ("5", "4")], "u string, p string")
    want = [str(21000 * 10**22), str(int("9" * 40) * int("7" * 40)), None, "20"]
    assert [r.f for r in rows.select(s.gas_fee(F.col("u"), F.col("p")).alias("f")).collect()] == want


def test_closed_range_fails_as_a_whole(spark):
    import pytest

    from ledgerlake.operators import selection

    rows = spark.createDataFrame([(1, "a", "x", 5, "p", 0), (1, "a", "x", 5, "p", 1), (1, "a", "y", 50, "p", 0)], "chain_id bigint, address string, tx_hash string, block bigint, provider string, transaction_index int")
    asked = spark.createDataFrame([(1, "a")], "chain_id bigint, address string")
    assert selection.closed_range("transactions", rows.filter("block < 9"), asked, 1, "p", 1, 9, ["transaction_index"]).count() == 1
    with pytest.raises(ValueError, match="RANGE"):
        selection.closed_range("transactions", rows, asked, 1, "p", 1, 9, ["transaction_index"])
