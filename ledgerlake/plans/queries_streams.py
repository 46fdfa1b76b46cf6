"""Registered queries that run streams and commits over landed tables, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerlake.lineage import shared_dir, stored
from ledgerlake.operators import identity, maintenance
from ledgerlake.operators.commits import CommitLog
from ledgerlake.operators.prices import SCOPE
from ledgerlake.plans import views as v
from ledgerlake.plans.queries_jobs import _FIRST, KEY
from ledgerlake.plans.registry import query
from ledgerlake.streaming import ingest, stateful

#: Longer than all of the tables' days: no fact is late.
EVER = "5000 days"


def _scratch(spark) -> str:
    return f"{shared_dir(spark)}/streams-{uuid.uuid4().hex}"


def _land(rows, path: str, files: int) -> None:
    rows.repartition(files).write.mode("append").parquet(path)


def _halves(rows):
    """Rows in two parts by a hash, column half, so that facts of one transaction come apart; made once."""
    made = stored(rows.withColumn("half", F.pmod("half", F.lit(2)).cast("int")))
    return [made.filter(F.col("half") == k).drop("half") for k in (0, 1)]


def _streamed(rows, path: str, work, sink) -> None:
    """Lands rows as they lie, in as many files as they have tasks, and works them off."""
    rows.write.mode("append").option("compression", "zstd").parquet(f"{path}/in")
    stream = ingest.landing(rows.sparkSession, f"{path}/in", rows.schema, form="parquet")
    ingest.run_available(work(stream), sink, f"{path}/mark").awaitTermination()


def _timed(facts):
    return facts.withColumn("ts", F.timestamp_seconds(F.unix_timestamp(F.lit("1995-01-01").cast("timestamp")) + F.col("block") * 86_400))


def _first(spark, d):
    """Transfers, one of each identity."""
    t = v.transfers(spark, d).withColumn("amount", F.col("amount").cast("bigint"))
    first = identity.first_wins(t, ["chain_id", "address", "tx_hash", "log_index", "token_address"], ["amount", "block", "from_address", "to_address", "ingestion_source"])
    return stored(first.withColumns({"identity": F.concat_ws(":", "chain_id", "tx_hash", "log_index", "token_address"), "amount": F.col("amount").cast("string")}))


@query(f"""SELECT address, identity, CASE WHEN log_index = 3 THEN amount || '0' ELSE CAST(amount AS VARCHAR) END AS amount FROM {_FIRST}""")
def sunk_facts(spark, d):
    """Three batches of two streams whose batch ids both begin at 0, one of them applied twice; the table holds all facts."""
    t = _first(spark, d)
    path = _scratch(spark)
    one, two = ingest.upsert_sink(path), ingest.upsert_sink(path)
    one(t.filter("log_index in (1, 3)"), 0, query="one")
    one(t.filter("log_index in (2, 4)"), 1, query="one")
    two(t.filter("log_index > 4 or log_index = 3").withColumn("amount", F.when(F.col("log_index") == 3, F.concat("amount", F.lit("0"))).otherwise(F.col("amount"))), 0, query="two")
    one(t.filter("log_index in (2, 4)").withColumn("amount", F.lit("never")), 1, query="one")
    one.log(spark).vacuum(1, 0)
    return one.read(spark).select("address", "identity", "amount")


@query(f"""SELECT address, count(*) FILTER (ingestion_source <> 'own' OR block < 988 OR block >= 1400 OR log_index <> 2) AS facts, CAST(10000 AS BIGINT) AS next_block, CAST(9999 AS BIGINT) AS last_complete_block, CAST(3 AS BIGINT) AS windows, CAST(3 AS BIGINT) AS runs FROM {_FIRST} GROUP BY address""")
def atomic_sync(spark, d):
    """Facts, cursors, windows and runs of three sync runs, each one commit; the second finds some facts gone."""
    t = _first(spark, d)
    log, accounts = CommitLog(spark, _scratch(spark)), stored(t.select(*KEY).distinct())
    spans = {"r1": (0, 999), "r2": (988, 1399), "r3": (1400, 9999)}
    for name, (first, last) in spans.items():
        fresh = t.filter(F.col("block").between(first, last) & (F.lit(name != "r2") | (F.col("ingestion_source") != "own") | (F.col("log_index") != 2)))
        windows = accounts.select(*KEY, *[F.lit(x).cast("bigint").alias(c) for c, x in (("start", first), ("end", last), ("target_block", 9999))])
        maintenance.commit_windows(log, fresh, windows, "own", name, ingest.block_bucket())
    now = log.snapshot()
    count = lambda table, c: log.read(table, now).groupBy(*KEY).agg(F.count("*").alias(c))
    rows = log.read("scopes", now).join(count("facts", "facts"), KEY).join(count("windows", "windows"), KEY).join(count("runs", "runs"), KEY)
    return rows.select("address", "facts", "next_block", "last_complete_block", "windows", "runs")


@query(v.MINTED_BALANCES)
def streamed_balances(spark, d):
    """Balances, income and outgo of a stream in which mints and sends of one transaction come in any order."""
    path = _scratch(spark)
    facts = _halves(_timed(v.minted(spark, d)).select("chain_id", "tx_hash", "token_address", "from_address", "to_address", "amount", "ts", F.xxhash64("tx_hash", "log_index").alias("half")))
    sink = stateful.balance_sink(f"{path}/table")
    with stateful.state_store(spark):
        for rows in facts:
            _streamed(rows, path, lambda stream: stateful.settled_balances(stream, EVER), sink)
    return sink.read(spark).select(*stateful.COLUMNS)


@query("SELECT chain_id, account AS address, token_address, block, CAST(sum(sum(gained) - sum(lost)) OVER (PARTITION BY chain_id, account, token_address ORDER BY block) AS VARCHAR) AS amount FROM v_entries GROUP BY chain_id, account, token_address, block")
def published_states(spark, d):
    """States of accounts as a stream publishes them, once for each complete block."""
    path = _scratch(spark)
    facts = _halves(_timed(v.transfers(spark, d)).select("chain_id", "token_address", "from_address", "to_address", "block", "amount", "ts", F.xxhash64("tx_hash", "log_index").alias("half")))
    end = facts[0].unionByName(facts[1]).limit(1).withColumns({"block": F.lit(20_000).cast("bigint"), "from_address": F.lit(None).cast("string"), "to_address": F.lit("end"), "ts": F.lit("2200-01-01").cast("timestamp")})
    sink = ingest.AppendSink(f"{path}/table")
    with stateful.state_store(spark):
        for rows in (*facts, end):  # the last makes all blocks of the others complete
            _streamed(rows, path, lambda stream: stateful.published_states(stream, EVER, 1), sink)
    return sink.read(spark).filter("kind = 'state'").select("chain_id", "address", "token_address", "block", "amount")


@query("""SELECT token_key, count(*) AS points, CAST(sum(price) AS BIGINT) AS total, max(ts) + INTERVAL 1 MINUTE AS next_from, CASE WHEN token_key = 'view' THEN 'stalled' ELSE 'ok' END AS status FROM (SELECT token_key, ts, arg_max(price, ordinal) AS price FROM v_prices GROUP BY ALL) GROUP BY token_key""")
def streamed_prices(spark, d):
    """A price tail in two batches, the second from where the first ended, and a scope for which nothing new came."""
    path = _scratch(spark)
    p = v.prices(spark, d).groupBy(*SCOPE, "ts").agg(F.max_by("price", "ordinal").alias("price"))
    old = F.to_date("ts") < F.lit("2024-01-15").cast("date")
    again = p.filter("token_key = 'view'").groupBy(*SCOPE).agg(F.min("ts").alias("ts")).withColumn("price", F.lit(-1).cast("bigint"))
    sink = stateful.TailSink(f"{path}/table")
    with stateful.state_store(spark):
        for rows in (p.filter(old | (F.col("token_key") == "view")), p.filter(~old & (F.col("token_key") != "view")).unionByName(again)):
            _land(rows, f"{path}/in", 2)
            stream = ingest.landing(spark, f"{path}/in", spark.read.parquet(f"{path}/in").schema, 2, "parquet")
            stateful.run_tail(stateful.price_tail(stream, 60_000), sink, f"{path}/mark").awaitTermination()
    log = CommitLog(spark, f"{path}/table")
    sums = log.read("points").groupBy(*SCOPE).agg(F.count("*").alias("points"), F.sum("price").cast("bigint").alias("total"))
    return log.read("control").join(sums, SCOPE).select("token_key", "points", "total", "next_from", "status")
