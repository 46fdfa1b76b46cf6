import random

import pytest

from pyspark.sql import functions as F

from ledgerlake.operators import identity, ledger, maintenance, selection, snapshots

A, B, TOKEN = "0x" + "a" * 40, "0x" + "b" * 40, "0x" + "c" * 40
TRANSFER = "chain_id bigint, address string, tx_hash string, log_index bigint, block bigint, token_address string, from_address string, to_address string, amount string, ingestion_source string"
NATIVE = "chain_id bigint, address string, tx_hash string, block bigint, from_address string, to_address string, value string, status string, input string"


def transfers(spark, rows):
    return spark.createDataFrame([(1, A, tx, log, block, TOKEN, src, dst, str(n), "own") for tx, log, block, src, dst, n in rows], TRANSFER)


def test_exact_balance(spark):
    t = transfers(spark, [("x", 0, 10, B, A, 90071992547409931234567890), ("y", 0, 11, A, B, 2)])
    got = {r.address: r for r in ledger.token_balances(t).collect()}
    assert got[A].amount == "90071992547409931234567888" and got[B].amount == "-90071992547409931234567888"
    assert ledger.negative_warnings(ledger.token_balances(t)).first().warnings == [f"negative_balance:{TOKEN}"]
    assert {r.amount for r in ledger.token_balances(t, 10).collect()} == {"90071992547409931234567890", "-90071992547409931234567890"}


def test_random_histories_match_a_reducer(spark):
    rng = random.Random(1)
    rows = [(f"x{i}", 0, rng.randrange(30), *rng.sample([A, B, ledger.ZERO], 2), rng.getrandbits(240)) for i in range(300)]
    t = transfers(spark, rows)
    state, want = {}, {}
    for _, _, block, src, dst, n in sorted(rows, key=lambda r: r[2]):
        for who, sign in ((src, -1), (dst, 1)):
            state[who] = state.get(who, 0) + sign * n
            want[who, block] = state[who]
    assert {(r.address, r.block): int(r.amount) for r in ledger.balance_history(t).collect()} == want
    at = snapshots.boundaries(t, 7, 1000)
    taken = snapshots.snapshots(t, at)
    assert all(int(r.amount) == want[r.address, r.block] for r in taken.collect())
    probes = spark.createDataFrame([(1, who, b) for who in (A, B) for b in (3, 14, 29)], "chain_id bigint, address string, at_block bigint")
    expect = {(who, b): [v for (w, k), v in sorted(want.items(), key=lambda x: x[0][1]) if w == who and k <= b][-1] for who in (A, B) for b in (3, 14, 29)}
    assert {(r.address, r.at_block): int(r.amount) for r in snapshots.at_block(taken, t, probes).collect()} == expect
    assert {(r.address, r.at_block): int(r.amount) for r in ledger.state_at(t, probes).collect()} == expect


def test_interest_settlement(spark):
    t = transfers(spark, [("x", 0, 1, B, A, 10**18), ("y", 0, 2, ledger.ZERO, A, 5 * 10**16), ("y", 1, 2, A, ledger.ZERO, 105 * 10**16)])
    r = ledger.token_balances(t).filter(F.col("address") == A).first()
    assert (r.amount, r.incoming, r.outgoing) == ("0", str(10**18), str(105 * 10**16))


def test_self_transfer_counts_on_both_sides(spark):
    r = ledger.token_balances(transfers(spark, [("x", 0, 1, A, A, 5)])).first()
    assert (r.amount, r.incoming, r.outgoing) == ("0", "5", "5")


def native(spark, rows):
    return spark.createDataFrame([(1, A, tx, block, src, dst, v, "success", data) for tx, block, src, dst, v, data in rows], NATIVE)


def test_cross_source_dedup(spark):
    tx = native(spark, [("x", 1, A, B, str(10**18), "0x")])
    legs = native(spark, [("x", 1, A, B, str(10**18), None)] * 2 + [("x", 1, A, B, "0", None)]).withColumn("identity", F.concat(F.lit("i"), F.monotonically_increasing_id()))
    one = legs.filter("value <> '0'").limit(1)
    for inner, out in ((one, 10**18), (legs, 2 * 10**18)):
        r = ledger.native_flows(tx, inner).filter(F.col("address") == A).first()
        assert (r.native_out, r.transaction_count) == (str(out), 1)


def test_wrapped_native(spark):
    weth = ledger.WRAPPED_NATIVE[1]
    amount = 1803965000000000000
    t = native(spark, [("x", 100, A, weth, str(amount), "0xd0e30db0"), ("y", 101, A, weth, "0", "0x2e1a7d4d" + format(amount, "064x")), ("z", 102, A, weth, "5", "0xffffffff")])
    none = spark.createDataFrame([], TRANSFER)
    made = ledger.wrapped_native(t, none)
    assert {(r.tx_hash, r.source, r.amount) for r in made.collect()} == {("x", "deposit", str(amount)), ("y", "withdrawal", str(amount))}
    facts = made.withColumn("address", F.lit(A))
    assert ledger.token_balances(facts).filter(F.col("address") == A).first().amount == "0"
    there = made.filter("source = 'deposit'").withColumn("address", F.lit(A))
    assert [r.source for r in ledger.wrapped_native(t, there).collect()] == ["withdrawal"]


def test_occurrences(spark):
    t = transfers(spark, [("x", None, 1, B, A, 5)] * 2).withColumn("block_number", F.lit("1")).withColumn("ordinal", F.lit(0))
    ids = sorted(r.identity for r in identity.with_occurrences(t, [F.col("ordinal")]).collect())
    assert len(set(ids)) == 2 and ids[1] == ids[0] + ":occurrence:1"


def test_snapshot_boundaries(spark):
    t = transfers(spark, [("x", 0, 1, B, A, 1), ("y", 0, 2, B, A, 1), ("z", 0, 2, B, A, 1)])
    assert [r.block for r in snapshots.boundaries(t, 1, 10**6).filter(F.col("address") == A).orderBy("block").collect()] == [1, 2]
    first = snapshots.replay(t, 1, 7, 1, 10**6)
    assert snapshots.replay(t, 2, 7, 1, 10**6, first).filter(F.col("address") == A).count() == 2


def test_keyset_page(spark):
    t = transfers(spark, [("x", 0, 1, B, A, 1), ("y", 0, 2, B, A, 2)])
    one = selection.page(t, ["block", "tx_hash"], None, 1).first()
    two = selection.page(t, ["block", "tx_hash"], (one.block, one.tx_hash), 1).first()
    assert (one.amount, one.has_next, two.amount, two.has_next) == ("1", True, "2", False)


def test_windows_and_replacement(spark):
    scopes = spark.createDataFrame([("a", 10, 11, None), ("b", 15, 99, None), ("c", 21, 99, 22)], "k string, next_block bigint, target_block bigint, asked_start bigint")
    got = {r.k: (r.start, r.end, r.conflict) for r in maintenance.plan_windows(scopes, 5, 2).collect()}
    assert got == {"a": (8, 11, False), "b": (13, 17, False), "c": (22, 26, True)}
    old = transfers(spark, [("x", 0, 10, B, A, 1), ("y", 0, 10, B, A, 2)]).withColumn("identity", F.col("tx_hash")).withColumn("ingestion_source", F.when(F.col("tx_hash") == "y", "external").otherwise("own"))
    new = transfers(spark, [("z", 0, 10, B, A, 3)]).withColumn("identity", F.col("tx_hash"))
    win = spark.createDataFrame([(1, A, 10, 10)], "chain_id bigint, address string, start bigint, end bigint")
    assert sorted(r.amount for r in maintenance.replace_overlap(old, new, win, "own").collect()) == ["2", "3"]
    assert tuple(maintenance.upsert_counts(old, old).first()) == (0, 2)
    assert tuple(maintenance.upsert_counts(old, new).first()) == (1, 0)
    assert maintenance.dry_run(old, win, "own").first().deletes == 1


def test_cover_and_gaps(spark):
    w = spark.createDataFrame([("a", 10, 11), ("a", 12, 13), ("b", 10, 11), ("b", 13, 13)], "s string, start bigint, end bigint").withColumn("first", F.lit(10)).withColumn("last", F.lit(13))
    assert [r.s for r in selection.exact_cover(w, ["s"], "first", "last").collect()] == ["b"]
    f = spark.createDataFrame([("a", 1), ("a", 2), ("a", 6)], "s string, block bigint")
    assert tuple(selection.gaps(f, ["s"]).first()) == ("a", 3, 5)


def test_bucket_rewrite_keeps_other_partitions(spark, tmp_path):
    rows = transfers(spark, [("x", 0, 5, B, A, 1), ("y", 0, 250, B, A, 2)])
    maintenance.write_buckets(rows, str(tmp_path), 100)
    maintenance.write_buckets(transfers(spark, [("z", 0, 251, B, A, 3)]), str(tmp_path), 100)
    assert sorted(r.amount for r in maintenance.read_buckets(spark, str(tmp_path)).collect()) == ["1", "3"]
    assert maintenance.read_buckets(spark, str(tmp_path), 200, 299, 100).count() == 1


def walk(rows, events, blocks):
    """Boundaries of one account's (block, facts), row by row."""
    out, begin, seen = [], rows[0][0], 0
    for block, n in rows:
        seen += n
        if seen >= events or block - begin + 1 >= blocks:
            out.append(block)
            begin, seen = block + 1, 0
    return sorted({*out, rows[-1][0]})


@pytest.mark.parametrize("large", [10**6, 20])
def test_boundaries_equal_the_walk(spark, monkeypatch, large):
    monkeypatch.setattr(snapshots, "LARGE", large)
    monkeypatch.setattr(snapshots, "SPAN", 30)
    rng = random.Random(large)
    counts = {f"a{k}": [(b, rng.randrange(1, 5)) for b in sorted(rng.sample(range(400), rng.randrange(1, 200)))] for k in range(12)}
    facts = [(f"x{i}", 0, b, B if i % 2 else name, name, 1) for name, rows in counts.items() for b, n in rows for i in range(n)]
    t = transfers(spark, facts).coalesce(2)
    for events, blocks in ((1, 1), (7, 10**6), (10**6, 9), (11, 23), (10**6, 10**6), (0, 0)):
        got = {}
        for r in snapshots.boundaries(t, events, blocks).filter(F.col("address") != B).collect():
            got.setdefault(r.address, []).append(r.block)
        assert {k: sorted(x) for k, x in got.items()} == {k: walk(rows, max(1, events), max(1, blocks)) for k, rows in counts.items()}, (events, blocks)


@pytest.mark.parametrize("large", [10**6, 0])
def test_resumed_boundaries_are_those_of_one_replay(spark, monkeypatch, large):
    monkeypatch.setattr(snapshots, "LARGE", large)
    rng = random.Random(1)
    t = transfers(spark, [(f"x{i}", 0, rng.randrange(300), f"a{i % 3}", f"b{i % 2}", 1) for i in range(400)])
    taken, pointer = snapshots.start(t, 100, 0, 9, 31)
    more, after = snapshots.resume(t, 300, taken, pointer, 9, 31)
    whole, end = snapshots.start(t, 300, 0, 9, 31)
    key = lambda rows: {tuple(r) for r in rows.select("address", "token_address", "block", "amount").collect()}
    assert key(whole) <= key(taken) | key(more)
    assert {tuple(r) for r in after.select(*end.columns).collect()} == {tuple(r) for r in end.collect()}
