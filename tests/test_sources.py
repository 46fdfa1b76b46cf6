"""Landed files, mappers of one's own, faulty rows, and databases."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import rational, u256
from ledgerlake.operators import ledger, lookup, prices
from ledgerlake.sources import candles, jdbc, payloads
from ledgerlake.streaming import ingest
from tests.test_ledger import A, B, transfers
from tests.test_streaming import fact, land


def test_landed_documents_are_whole(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"status": "1",\n "message": "OK", "result": []}')
    (tmp_path / "b.json").write_text("not json\nat all")
    got = payloads.read_landed(spark, str(tmp_path))
    assert {r.file.rpartition("/")[2]: r.body.count("\n") for r in got.collect()} == {"a.json": 1, "b.json": 1}
    assert {r.outcome for r in payloads.triage(got).collect()} == {"ok", "malformed"}


def test_faulty_rows_are_set_aside(spark):
    rows = spark.createDataFrame([("x", 1), (None, 2), ("y", None), (None, None)], "tx_hash string, block int")
    whole, faulty = payloads.quarantine(rows, ["tx_hash", "block"])
    assert [r.tx_hash for r in whole.collect()] == ["x"] and faulty.count() == 3
    assert payloads.quarantine(rows, [])[0].count() == 4


def test_a_mapper_of_ones_own(spark, monkeypatch):
    monkeypatch.setattr(payloads, "MAPPERS", dict(payloads.MAPPERS))
    raw = spark.createDataFrame([("h", 7)], "h string, n int")
    payloads.register("mine", "transactions", lambda rows, provider: rows.select(F.col("h").alias("tx_hash"), F.col("n").alias("block"), F.lit(provider).alias("provider")), ("tx_hash", "block"))
    assert [tuple(r) for r in payloads.normalise("mine", "transactions", raw, "p").collect()] == [("h", 7, "p")]
    payloads.register("mine", "transactions", lambda rows, provider: rows, ("tx_hash",))
    with pytest.raises(ValueError, match="tx_hash"):
        payloads.normalise("mine", "transactions", raw, "p")
    with pytest.raises(KeyError):
        payloads.normalise("mine", "holdings", raw, "p")


def test_a_landing_zone_in_small_batches(spark, tmp_path):
    schema = spark.createDataFrame([fact("x", 1, 1)]).schema
    for k in range(3):
        land(tmp_path / "in", f"{k}.json", [fact(f"x{k}", k, k)])
    sizes = []
    ingest.run_available(ingest.landing(spark, str(tmp_path / "in"), schema, 1), lambda rows, k: sizes.append(rows.count()), str(tmp_path / "mark")).awaitTermination()
    assert [n for n in sizes if n] == [1, 1, 1]


def test_a_manifest_tells_repeated_pools(spark):
    rows = spark.createDataFrame([("b", "P1", "t", "q", 500), ("a", "p1", "T", "Q", 500), ("c", "p1", "t", "q", 3000)], "id string, pool_address string, token_address string, quote_token string, fee int")
    ordered, faults = candles.manifest(rows)
    assert [r.id for r in ordered.collect()] == ["a", "b", "c"] and {r.id for r in faults.collect()} <= {"a", "b"} and faults.count() >= 1


@pytest.fixture
def url():
    return f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"


def rows_in(spark, url, table):
    return sorted(tuple(r) for r in spark.read.format("jdbc").option("url", url).option("dbtable", table).load().collect())


def test_an_export_runs_once(spark, url, monkeypatch):
    rows = lambda xs: spark.createDataFrame(xs, "id string, amount string, block bigint")
    first = [(f"0x{k:03x}", str(10**40 + k), k) for k in range(60)]
    jdbc.export(rows(first), url, "facts", ["id"], "r1", 4)
    assert rows_in(spark, url, "facts") == sorted(first)
    jdbc.export(rows([("0x000", "never", 0)]), url, "facts", ["id"], "r1", 4)
    assert rows_in(spark, url, "facts") == sorted(first)
    second = [(i, a, b + 1) for i, a, b in first[::3]] + [("0xfff", "9", 9), ("o'x", "it's", 1)]
    calls, write = [], jdbc._write

    def failing(*args):
        calls.append(args[3])
        if calls.count("append") == 3 and args[3] == "append":
            write(*args)
            raise OSError("lost after it was written")
        write(*args)

    monkeypatch.setattr(jdbc, "_write", failing)
    with pytest.raises(OSError, match="lost"):
        jdbc.export(rows(second), url, "facts", ["id"], "r2", 4)
    assert rows_in(spark, url, "facts") == sorted(first)
    jdbc.export(rows(second), url, "facts", ["id"], "r2", 4)
    assert calls.count("append") == 5  # the lost part is written again, those before it are not
    want = sorted(second + [r for r in first if r[0] not in {s[0] for s in second}])
    assert rows_in(spark, url, "facts") == want and rows_in(spark, url, "facts_stage") == []
    got = jdbc.read_ranges(spark, url, "facts", "id", jdbc.text_bounds(3))
    assert got.rdd.getNumPartitions() == 3 and sorted(map(tuple, got.collect())) == want
    assert sorted(map(tuple, jdbc.read_ranges(spark, url, "facts", "id", []).collect())) == want


# What operators gained beside.


def test_ratios_in_order_at_any_size():
    import random

    rng = random.Random(1)
    big = lambda: rng.getrandbits(rng.choice([1, 8, 64, 600, 1200, 2600])) + 1
    pairs = [(big(), big()) for _ in range(150)] + [(a, b) for a in range(1, 9) for b in range(1, 9)]
    pairs += [(1 << 748, 1), (3 << 746, 1), ((1 << 1200) + 1, 1 << 1200), (1, 1), ((1 << 1200) - 1, 1 << 1200)]
    from fractions import Fraction

    texts = sorted((rational.order_text(a, b), Fraction(a, b)) for a, b in pairs)
    assert [f for _, f in texts] == sorted(f for _, f in texts)
    assert len({t for t, _ in texts}) == len({f for _, f in texts})


def test_exact_sums_in_sql(spark):
    u256.register(spark)
    values = [str(10**77), "-" + "9" * 60, "0", "007", None, "-1", "x", str(10**26), "-" + str(10**26), "123456789012345678901234567"]
    rows = spark.createDataFrame([(k % 2, v) for k, v in enumerate(values)] + [(2, str(10**30 + k)) for k in range(500)] + [(3, None), (4, "-5"), (4, "5"), (5, "-" + str(10**52))], "k int, v string")
    got = spark.sql(f"SELECT k, {u256.sql_sum('v')} AS total FROM {{rows}} GROUP BY k", rows=rows)
    number = lambda v: int(v) if v and v.lstrip("-").isdigit() else 0
    want = {k: str(sum(number(v) for _, v in (x for x in enumerate(values) if x[0] % 2 == k))) for k in (0, 1)}
    want |= {2: str(500 * 10**30 + sum(range(500))), 3: None, 4: "0", 5: "-" + str(10**52)}
    assert {r.k: r.total for r in got.collect()} == want
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "partial_sum" in plan


def test_a_sieve_keeps_what_may_match(spark, monkeypatch):
    rows = spark.range(5000).withColumn("k", F.col("id").cast("string"))
    few = rows.filter("id % 1000 = 0").unionByName(spark.createDataFrame([(None, None)], "id bigint, k string"))
    kept = ledger.sieved(rows, few, ["k"])
    assert rows.join(few, "k", "left_semi").count() == kept.join(few, "k", "left_semi").count() == 5 and kept.count() < 200
    monkeypatch.setattr(ledger, "SIEVE", 1)
    assert ledger.sieved(rows, few, ["k"]).count() == 5000
    assert "BroadcastHashJoin" in kept._jdf.queryExecution().toString()


def test_groups_that_failed(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 2, "X"), ("b", 3, "Y"), ("b", 4, "X"), (None, 5, "Z"), ("c", 6, None)], "source string, n int, code string")
    good, failed = prices.unless_all_failed(rows, ["source"])
    assert sorted(r.n for r in good.collect()) == [1, 2, 6]
    assert {tuple(r) for r in failed.collect()} == {("b", 2, "X"), (None, 1, "Z")}
    with pytest.raises(ValueError, match="all requests failed"):
        prices.or_raise(rows, ["source"])
    assert prices.or_raise(rows).count() == 6
    bad = rows.filter("code is not null")
    assert prices.unless_all_failed(bad)[0].count() == 0
    with pytest.raises(ValueError, match="'requested': 4"):
        prices.or_raise(bad)
    assert prices.or_raise(bad.limit(0)).count() == 0


def test_the_first_code_of_a_pair(spark):
    registry = spark.createDataFrame([("1", A, B, "AA", "BB"), ("2", A, "0x" + "c" * 40, "AA", "BB")], "id string, token0 string, token1 string, symbol0 string, symbol1 string")
    asked = spark.createDataFrame([(1, "nope", "BB"), (2, "BB", "nope"), (3, "AA", "BB"), (4, "AA", "nope"), (5, "AA", "aa"), (6, "AA", B)], "request int, a string, b string")
    got = {r.request: (r.id, r.code) for r in lookup.pairs(asked, registry).collect()}
    assert got == {1: (None, "TOKEN_UNKNOWN"), 2: (None, "TOKEN_AMBIGUOUS"), 3: (None, "TOKEN_AMBIGUOUS"), 4: (None, "TOKEN_UNKNOWN"), 5: (None, "SAME_TOKEN"), 6: ("1", None)}


def test_pointers_of_accounts_are_dropped(spark):
    from ledgerlake.operators import snapshots

    t = transfers(spark, [("x", 0, 4, B, A, 1), ("y", 0, 9, B, A, 1)])
    taken, pointer = snapshots.start(t, 9, 0, 1, 1)
    left = snapshots.drop_pointers(pointer, taken.filter(F.col("address") == A))
    assert [r.address for r in left.collect()] == [B]
    whole = snapshots.replay(t, 9, 0, 1, 1)
    again = snapshots.replay(t, 9, 0, 1, 1, earlier=snapshots.replay(t, 4, 0, 1, 1))
    assert sorted(map(repr, again.select(*whole.columns).collect())) == sorted(map(repr, whole.collect()))
