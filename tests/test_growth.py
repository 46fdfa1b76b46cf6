"""What grows with the tables: shuffles of merges, rows of intermediate steps."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from ledgerlake.functions import rational, u256
from ledgerlake.operators import atblock, commits, ledger, maintenance, selection, snapshots


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def facts(spark, rows):
    return spark.createDataFrame(rows, "chain_id bigint, address string, identity string, block bigint, ingestion_source string, amount string")


def test_a_merge_is_dealt_once_to_the_tasks_that_write_it(spark, tmp_path):
    old = facts(spark, [(1, "a", "x", 5, "own", "1"), (1, "a", "y", 6, "own", "2")])
    new = facts(spark, [(1, "a", "y", 6, "own", "3"), (1, "b", "z", 7, "own", "4")])
    bucket = F.lit("0")
    rows = maintenance.upsert(old, new, place=lambda r: commits.placed(r, bucket, maintenance.KEY, 8))
    assert exchanges(rows) == 1
    log = commits.CommitLog(spark, str(tmp_path))
    parts = log.write("facts", rows, bucket)
    log.commit(log.snapshot(), {"facts": (old.schema, parts)})
    assert sorted(map(tuple, log.read("facts").select("identity", "amount").collect())) == [("x", "1"), ("y", "3"), ("z", "4")]
    assert commits.splits([10]) == commits.SPLITS and commits.splits([10, 100 * commits.ROWS]) == 100


def test_facts_that_no_window_can_hold_stay(spark):
    old = facts(spark, [(1, "a", "x", 5, "own", "1"), (1, "a", "y", 50, "own", "2"), (1, "a", "z", 5, "other", "3"), (1, "b", "w", 5, "own", "4"), (1, "a", "u", 5, None, "5")])
    windows = spark.createDataFrame([(1, "a", 0, 9), (1, "c", 10, 40)], "chain_id bigint, address string, start bigint, end bigint")
    assert sorted(r.identity for r in maintenance.left_over(old, windows, "own").collect()) == ["u", "w", "y", "z"]
    assert maintenance.left_over(old, windows.limit(0), "own").count() == 5


def test_tasks_of_halved_windows_grow_with_their_counts(spark, monkeypatch):
    monkeypatch.setattr(selection, "TASK_ROWS", 10)
    rows = spark.createDataFrame([("a", b, 0) for b in range(70)] + [("b", 5, 0)] * 3, "scope string, block bigint, x int")
    ranges = spark.createDataFrame([("a", 0, 99), ("b", 5, 5), ("c", 3, 9), ("c", 9, 3)], "scope string, first bigint, last bigint")
    found = selection.halved(rows, ranges, 2)
    assert found.rdd.getNumPartitions() == 8  # of 71 counts
    got = {(r.scope, r.start, r.end): (r.records, r.over) for r in found.collect()}
    assert got["b", 5, 5] == (3, True) and got["c", 3, 9] == (0, False) and ("c", 9, 3) not in got
    mine = sorted(k[1:] for k in got if k[0] == "a")
    assert mine[0][0] == 0 and mine[-1][1] == 99 and all(x[1] + 1 == y[0] for x, y in zip(mine, mine[1:]))
    assert all(got["a", lo, hi][0] == max(0, min(hi, 69) - lo + 1) <= 2 for lo, hi in mine)


@pytest.mark.parametrize("name", ["overlap_replacement", "deduplicated_transfers", "all_interest_settlement", "interest_settlement", "complete_ranges"])
def test_facts_that_several_steps_read_are_joined_once(spark, name):
    df = __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")
    assert df.inputFiles() and not any("lineitem" in f for f in df.inputFiles())


@pytest.mark.parametrize(("name", "parses"), [("explorer_transfer_payloads", 2), ("explorer_internal_payloads", 2)])
def test_a_payload_is_parsed_once(spark, name, parses):
    df = __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == parses  # the envelope and its records


def history(spark, n=120):
    rows = [(1, "a" if k % 3 else "b", "c" if k % 5 else "a", f"t{k % 4}", k * 7 % 90, str(k + 10 ** (k % 60))) for k in range(n)]
    return spark.createDataFrame(rows, "chain_id bigint, from_address string, to_address string, token_address string, block bigint, amount string")


def test_moves_are_shuffled_once_for_balances_at_snapshots(spark):
    taken = snapshots.take(history(spark), 20, 50)
    assert exchanges(taken) <= 2  # the moves and the boundaries
    more, _ = snapshots.resume(history(spark), 90, *(x.localCheckpoint() for x in snapshots.start(history(spark), 40, 7, 20, 50)), 20, 50, 7)
    asked = spark.createDataFrame([(1, a, b) for a in "abc" for b in (30, 60)], "chain_id bigint, address string, at_block bigint")
    for df in (more, snapshots.at_block(taken, history(spark), asked)):
        assert "__probe" not in df._jdf.queryExecution().executedPlan().toString()  # moves are not looked up as of marks


@pytest.mark.parametrize(("few", "large"), [(1, 10**6), (128, 30)])
def test_hubs_have_the_balances_that_others_have(spark, monkeypatch, few, large):
    t = history(spark)
    asked = spark.createDataFrame([(1, a, b) for a in "abcd" for b in (3, 30, 31, 60, 95)], "chain_id bigint, address string, at_block bigint")

    def all_of():
        taken = snapshots.take(t, 10, 25).localCheckpoint()
        earlier, pointer = (x.localCheckpoint() for x in snapshots.start(t, 40, 7, 10, 25))
        frames = taken, snapshots.resume(t, 90, earlier, pointer, 10, 25, 7)[0], snapshots.at_block(taken.filter("block < 70"), t, asked)
        return [sorted(map(tuple, f.select("address", "token_address", f.columns[3], "amount", *f.columns[:1]).collect())) for f in frames]

    want = all_of()
    monkeypatch.setattr(snapshots, "FEW", few)
    if large < 10**6:
        monkeypatch.setattr(snapshots, "LARGE", large)
    assert all_of() == want and all(want)


def test_pointers_are_told_without_balances(spark, monkeypatch):
    from ledgerlake.operators import snapshots as at
    from ledgerlake.plans import queries_jobs

    seen = []
    for module in (at, queries_jobs):
        monkeypatch.setattr(module, "cut", lambda df, f=module.cut: (seen.append(df.columns), f(df))[1])
    assert queries_jobs.replay_pointers(spark, "/root/testdata/sf0.001").count()
    assert seen and not any("amount" in c for c in seen)


def test_sums_of_nines_are_exact(spark):
    numbers = [0, 7, -7, 10**9, -(10**18) + 1, 10**18, 10**27 + 1, -(10**54) - 5, 2**256 - 1, -(2**255), 123456789012345678]
    rows = spark.createDataFrame([(k, str(n), k % 2 == 1) for k, n in enumerate(numbers)] + [(99, "x", False), (98, None, True)], "id int, amount string, lost boolean")
    nines = u256.in_nines(rows, "amount", F.col("lost"))
    got = {r.id: r.text for r in nines.select("id", u256.nines_text().alias("text")).collect()}
    assert got == {k: str(-n if k % 2 else n) for k, n in enumerate(numbers)} | {99: "0", 98: "0"}
    total = nines.agg(*[F.sum(c).alias(c) for c in u256.NINES]).select(u256.nines_text().alias("text")).first().text
    assert total == str(sum(-n if k % 2 else n for k, n in enumerate(numbers)))


@pytest.mark.parametrize("name", ["pool_prices", "pool_spot_prices"])
def test_words_of_pools_are_not_turned_into_digits_in_columns(spark, name):
    plan = __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in plan and "decimal(26,0)" not in plan


@pytest.mark.parametrize("name", ["pool_prices", "pool_spot_prices", "state_view_prices"])
def test_words_of_pools_are_checked_once_and_priced_in_one_python_stage(spark, name):
    plan = __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("conv(") == 1
    assert plan.lower().count("rlike") - plan.count("(0{58}") == 1  # the fee words have their own


def test_ticks_of_pools_are_those_of_their_words(spark):
    ticks = [0, 1, -1, 887272, -887272, 887273, -887273, 2**23 - 1, 2**23, -(2**23), 2**24 - 1, 2**24, 2**255, -(2**24) - 1]
    requests = spark.createDataFrame([(k, str(k), True, 18, 6, 1, 5) for k in range(len(ticks))], "request int, pool string, base_is_0 boolean, decimals0 int, decimals1 int, chain_id bigint, block bigint")
    results = spark.createDataFrame([(1, 5, str(k), True, "0x" + f"{2**96:064X}" + f"{t % 2**256:064X}" + "0" * 64 * 5) for k, t in enumerate(ticks)], "chain_id bigint, block bigint, call_id string, success boolean, return_data string")
    got = {r.request: (r.code, r.tick, r.by_tick.num) for r in atblock.pool_prices(requests, results).collect()}
    price = lambda t: str(rational.sqrt_at_tick(t) ** 2 * 10**18)
    assert got == {k: (None, t, price(t)) if abs(t) <= 887272 else ("RESPONSE_INVALID", None, None) for k, t in enumerate(ticks)}


def test_bounds_of_a_pools_word(spark):
    requests = spark.createDataFrame([(k, str(k), True, 18, 6, 1, 5) for k in range(4)], "request int, pool string, base_is_0 boolean, decimals0 int, decimals1 int, chain_id bigint, block bigint")
    words = [0, 2**96, 10**49 - 1, 10**49]
    results = spark.createDataFrame([(1, 5, str(k), True, "0x" + f"{w:064X}" + "0" * 64 * 6) for k, w in enumerate(words)], "chain_id bigint, block bigint, call_id string, success boolean, return_data string")
    got = {r.request: (r.code, r.spot.num) for r in atblock.pool_prices(requests, results).collect()}
    assert got == {k: ("RESPONSE_INVALID", None) if k in (0, 3) else (None, str(w * w * 10**18)) for k, w in enumerate(words)}


def test_balances_are_sums_of_longs_in_tasks_that_grow_with_the_facts(spark, monkeypatch):
    monkeypatch.setattr(ledger, "TASK_FACTS", 10)
    assert ledger.dealt(history(spark)).rdd.getNumPartitions() == 12  # of 120 facts
    plan = ledger.balance_history(history(spark))._jdf.queryExecution().executedPlan().toString()
    assert "__n0" in plan
    want = {}
    for r in history(spark).collect():
        for who, side in ((r.to_address, 0), (r.from_address, 1)):
            want.setdefault((who, r.token_address), [0, 0])[side] += int(r.amount)
    got = {(r.address, r.token_address): [int(r.incoming), int(r.outgoing)] for r in ledger.token_balances(history(spark).withColumn("tx_hash", F.col("block").cast("string"))).collect()}
    assert got == want


def rate_calls(spark, n, asks=1):
    word = lambda x: f"{x:064x}"
    tokens = spark.createDataFrame([(str(k), "uniswap-v2-lp", str(10 * (a + 1)), ["a", "b"], 1, 5) for k in range(n) for a in range(asks)], "token_id string, adapter string, sample string, legs array<string>, chain_id bigint, block bigint")
    calls = [(1, 5, f"{k}::{part}", True, "0x" + data) for k in range(n) for part, data in (("reserves", word(k + 1) + word(2 * k + 2) + word(0)), ("supply", word(1)))]
    return tokens, spark.createDataFrame([*calls, (1, 5, None, True, "0x")], "chain_id bigint, block bigint, call_id string, success boolean, return_data string")


def test_calls_of_rates_are_gathered_in_tasks_that_grow_with_them(spark, monkeypatch):
    monkeypatch.setattr(atblock, "TASK_CALLS", 10, raising=False)
    rates = atblock.exchange_rates(*rate_calls(spark, 40))
    plan = rates._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "BroadcastExchange" not in plan
    assert rates.rdd.getNumPartitions() == 12 and plan.count("Exchange hashpartitioning") == 1  # of 120 calls and tokens
    assert {r.token_id: (r.code, r.amounts) for r in rates.collect()} == {str(k): (None, [str(10 * (k + 1)), str(20 * (k + 1))]) for k in range(40)}


def test_a_token_that_is_asked_twice_at_a_block_has_two_rows(spark):
    got = sorted((r.token_id, r.code, r.amounts) for r in atblock.exchange_rates(*rate_calls(spark, 2, asks=2)).collect())
    assert got == [("0", None, ["10", "20"]), ("0", None, ["20", "40"]), ("1", None, ["20", "40"]), ("1", None, ["40", "80"])]
