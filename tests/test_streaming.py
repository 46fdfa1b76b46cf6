import json

from pyspark.sql import functions as F

from ledgerlake.functions import u256
from ledgerlake.streaming import ingest
from tests.test_ledger import TRANSFER, A, B, transfers


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def fact(tx, block, amount, source="own"):
    return {"chain_id": 1, "address": A, "tx_hash": tx, "log_index": 0, "block": block, "token_address": "t", "from_address": B, "to_address": A, "amount": str(amount), "ingestion_source": source, "identity": tx, "ts": "2024-01-01T00:00:00Z"}


def test_upserts_resume_and_repeat(spark, tmp_path):
    schema = spark.createDataFrame([], TRANSFER + ", identity string, ts timestamp").schema
    sink = ingest.upsert_sink(str(tmp_path / "table"))
    work = lambda: ingest.run_available(ingest.landing(spark, str(tmp_path / "in"), schema), sink, str(tmp_path / "mark")).awaitTermination()
    land(tmp_path / "in", "1.json", [fact("x", 1, 5), fact("y", 2, 6)])
    work()
    land(tmp_path / "in", "2.json", [fact("y", 2, 7), fact("z", 3, 8)])
    work()
    work()
    assert {(r.identity, r.amount) for r in sink.read(spark).collect()} == {("x", "5"), ("y", "7"), ("z", "8")}
    batch = sink.read(spark).limit(0)
    sink(batch, 1)  # a batch that runs again rewrites its own version from the one before
    assert {r.identity for r in sink.read(spark, before=1).collect()} == {"x", "y"}


def test_overlap_sink(spark, tmp_path):
    sink = ingest.overlap_sink(str(tmp_path / "table"), "own")
    rows = lambda xs: transfers(spark, xs).withColumn("identity", F.col("tx_hash"))
    sink(rows([("x", 0, 10, B, A, 1), ("y", 0, 12, B, A, 2)]), 0)
    sink(rows([("z", 0, 12, B, A, 3)]), 1)
    assert sorted(r.amount for r in sink.read(spark).collect()) == ["1", "3"]


def test_overlap_sink_replaces_the_collected_windows(spark, tmp_path):
    sink = ingest.overlap_sink(str(tmp_path / "table"), "own")
    rows = lambda xs: transfers(spark, xs).withColumn("identity", F.col("tx_hash"))
    kept = lambda: sorted(r.identity for r in sink.read(spark).collect())
    windows = lambda *xs: spark.createDataFrame([(1, A, *x) for x in xs], "chain_id bigint, address string, start bigint, end bigint")
    sink(rows([("a", 0, 5, B, A, 1), ("b", 0, 400, B, A, 2), ("c", 0, 990, B, A, 3), ("d", 0, 1000, B, A, 4)]), 0)
    sink(rows([("e", 0, 5, B, A, 5), ("f", 0, 1000, B, A, 6)]), 1)
    assert kept() == ["b", "c", "e", "f"]
    sink(rows([("g", 0, 1001, B, A, 7)]), 2, windows((0, 6), (989, 1001)))
    assert kept() == ["b", "g"]
    sink(rows([]), 3, windows((390, 402)))
    assert kept() == ["g"]


def test_running_balances(spark, tmp_path):
    schema = spark.createDataFrame([], TRANSFER + ", identity string, ts timestamp").schema
    land(tmp_path / "in", "1.json", [fact("x", 1, 5), fact("y", 2, 6), fact("y", 2, 6)])
    stream = ingest.without_repeats(ingest.landing(spark, str(tmp_path / "in"), schema))
    q = ingest.running_balances(stream).writeStream.format("memory").queryName("bal").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("bal").select("address", u256.render(u256.limbs(F.col("hi"), F.col("mid"), F.col("lo"))).alias("v")).collect()
    assert {(r.address, r.v) for r in got} == {(A, "11"), (B, "-11")}
    asked = ingest.replay_requests(transfers(spark, [("x", 0, 4, B, A, 1), ("y", 0, 9, B, A, 1)])).first()
    assert (asked.from_block, asked.to_block) == (4, 9)


def test_buckets_that_are_not_touched_stay(spark, tmp_path):
    sink = ingest.overlap_sink(str(tmp_path / "table"), "own")
    rows = lambda xs: transfers(spark, xs).withColumn("identity", F.col("tx_hash"))
    sink(rows([("a", 0, 5, B, A, 1), ("b", 0, ingest.WIDTH + 5, B, A, 2)]), 0)
    sink(rows([("c", 0, 6, B, A, 3)]), 1)
    newest = {r.bucket: r.v for r in sink.versions(spark).collect()}
    assert newest == {"1-0": 1, "1-1": 0}
    sink(rows([]), 2, spark.createDataFrame([(1, A, 0, 10)], "chain_id bigint, address string, start bigint, end bigint"))
    assert [r.identity for r in sink.read(spark).collect()] == ["b"]
    assert sorted(r.identity for r in sink.read(spark, before=2).collect()) == ["a", "b", "c"]


def test_price_sink(spark, tmp_path):
    sink = ingest.price_sink(str(tmp_path / "prices"))
    row = lambda ts, price: ("t", "x", "spot", "USD", "1m", ts, price)
    rows = lambda xs: spark.createDataFrame(xs, "token_key string, exchange string, market string, quote string, interval string, ts string, price int").withColumn("ts", F.col("ts").cast("timestamp"))
    sink(rows([row("2024-01-01 00:00:00", 1), row("2024-01-02 00:00:00", 2)]), 0)
    sink(rows([row("2024-01-02 00:00:00", 3), row("2024-01-02 00:01:00", 4)]), 1)
    assert sorted(r.price for r in sink.read(spark).collect()) == [1, 3, 4]


def test_blocks_are_published_when_complete(spark, tmp_path):
    schema = spark.createDataFrame([], TRANSFER + ", identity string, ts timestamp").schema
    late = {"ts": "2024-01-01T01:00:00Z"}
    land(tmp_path / "in", "1.json", [fact("x", 1, 5), fact("y", 1, 6), fact("z", 9, 7) | late])
    stream = ingest.landing(spark, str(tmp_path / "in"), schema)
    for name, rows in (("net", ingest.published_balances(stream)), ("sums", ingest.complete_blocks(ingest.landing(spark, str(tmp_path / "in"), schema)))):
        q = rows.writeStream.format("memory").queryName(name).outputMode("append").start()
        q.processAllAvailable()
        q.stop()
    assert {(r.address, r.block, int(r.lo)) for r in spark.table("net").collect()} == {(A, 1, 11), (B, 1, -11)}
    assert [(r.block, r.transfers, int(r.lo)) for r in spark.table("sums").collect()] == [(1, 2, 11)]


def test_monitor_looks_at_touched_scopes(spark):
    rows = transfers(spark, [("x", 0, 4, B, A, 1), ("y", 0, 9, B, A, 1)]).withColumn("identity", F.col("tx_hash"))
    scopes = spark.createDataFrame([(1, A, 10, 9), (1, B, 5, 4)], "chain_id bigint, address string, next_block bigint, last_complete_block bigint")
    got = ingest.monitor(scopes, rows, rows.limit(1)).collect()
    assert [(r.address, r.facts, r.gaps, r.status) for r in got] == [(A, 2, 1, "attention")]
