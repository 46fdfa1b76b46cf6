"""Incremental maintenance of fact tables (survey 2.10)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.commits import PLACE, CommitLog, placed, splits
from ledgerlake.operators.identity import last_wins
from ledgerlake.operators.selection import gaps

OVERLAP = 12
KEY = ["chain_id", "address", "identity"]
#: Blocks of a bucket of facts, and buckets of scopes.
WIDTH, SCOPE_BUCKETS = 100_000, 64


def plan_windows(scopes: DataFrame, window: int, overlap: int = OVERLAP) -> DataFrame:
    """start and end of every scope's next window; conflict where an asked start leaves a hole after the cursor.

    scopes: any key columns, next_block (the cursor, null at first), target_block, asked_start (nullable).
    """
    cursor = F.coalesce("next_block", F.lit(0))
    start = F.coalesce("asked_start", F.greatest(cursor - overlap, F.lit(0)))
    rows = scopes.withColumn("start", start).withColumn("end", F.least(start + window - 1, F.col("target_block")))
    return rows.withColumn("conflict", F.coalesce(F.col("asked_start") > cursor, F.lit(False))).withColumn("done", F.col("start") > F.col("target_block"))


def _inside(source: str, first: Column, last: Column) -> Column:
    return (F.col("ingestion_source") == source) & F.col("block").between(first, last)


def replace_overlap(facts: DataFrame, fresh: DataFrame, windows: DataFrame, source: str, place: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Facts with own-source rows of each account's window replaced by a new collection; rows of other sources stay.

    windows: chain_id, address, start, end, any number for an account.
    """
    w = _windows(windows)
    new = fresh.join(w, _of(fresh, w) & fresh["block"].between(w["start"], w["end"]), "left_semi").select(*facts.columns)
    return upsert(left_over(facts, windows, source), new, place=place)


def _windows(windows: DataFrame) -> DataFrame:
    return windows.select(F.col("chain_id").alias("__chain"), F.col("address").alias("__account"), "start", "end")


def _of(rows: DataFrame, w: DataFrame) -> Column:
    return (rows["chain_id"] == w["__chain"]) & (rows["address"] == w["__account"])


def left_over(facts: DataFrame, windows: DataFrame, source: str) -> DataFrame:
    """Facts without own-source rows of the windows. Only those that can be in a window, by source and by the blocks of all, are joined to them."""
    w = _windows(windows)
    edge = windows.agg(F.min("start").alias("__low"), F.max("end").alias("__high"))
    told = facts.crossJoin(F.broadcast(edge)).withColumn("__near", F.coalesce(_inside(source, F.col("__low"), F.col("__high")), F.lit(False))).drop("__low", "__high")
    near, far = told.filter("__near").drop("__near"), told.filter("not __near").drop("__near")
    return far.unionByName(near.join(w, _of(near, w) & near["block"].between(w["start"], w["end"]), "left_anti"))


def upsert(facts: DataFrame, fresh: DataFrame, key: list[str] | None = None, place: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Facts with fresh rows added or overwritten by identity.

    place: deals rows to tasks by a hash of their key (:func:`commits.placed`), whose columns the result has, too; it is then the only shuffle.
    """
    both = facts.withColumn("__new", F.lit(0)).unionByName(fresh.withColumn("__new", F.lit(1)))
    at = PLACE if place else []
    return last_wins(place(both) if place else both, [*at, *(key or KEY)], ["__new"]).select(*at, *facts.columns)


def upsert_counts(facts: DataFrame, fresh: DataFrame, key: list[str] | None = None) -> DataFrame:
    """written, the identities not there before, and duplicates, all other fresh rows."""
    key = key or KEY
    seen = fresh.select(*key).withColumn("f", F.lit(1)).unionByName(facts.select(*key).withColumn("f", F.lit(0)))
    by = seen.groupBy(*key).agg(F.min("f").alias("new"), F.sum("f").alias("n"))
    return by.agg(F.coalesce(F.sum(F.when((F.col("new") == 1) & (F.col("n") > 0), 1).otherwise(0)), F.lit(0)).cast("bigint").alias("written"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows")).select("written", (F.col("rows") - F.col("written")).alias("duplicates"))


def dry_run(facts: DataFrame, windows: DataFrame, source: str) -> DataFrame:
    """deletes: how many own-source facts a replacement would take from each account."""
    told = facts.join(windows.select("chain_id", "address", "start", "end"), ["chain_id", "address"]).filter(_inside(source, F.col("start"), F.col("end")))
    return told.groupBy("chain_id", "address").agg(F.count("*").alias("deletes"))


def recollect(facts: DataFrame, fresh: DataFrame, windows: DataFrame, source: str, mode: str = "replace") -> DataFrame:
    if mode == "replace":
        return replace_overlap(facts, fresh, windows, source)
    if mode == "merge":
        return upsert(facts, fresh)
    if mode == "dry-run":
        return dry_run(facts, windows, source)
    raise ValueError(f"no such mode: {mode}")


def commit(scopes: DataFrame, done: DataFrame) -> DataFrame:
    """Scopes after windows (chain_id, address, end) were written: the cursor and the last block only move forward."""
    last = done.groupBy("chain_id", "address").agg(F.max("end").alias("__end"))
    rows = scopes.join(last, ["chain_id", "address"], "left")
    return rows.withColumn("next_block", F.greatest("next_block", F.col("__end") + 1)).withColumn("last_complete_block", F.greatest("last_complete_block", "__end")).drop("__end")


SCOPES = "chain_id bigint, address string, next_block bigint, target_block bigint, last_complete_block bigint, status string"


def commit_windows(log: CommitLog, fresh: DataFrame, windows: DataFrame, source: str, run_id: str, bucket: Column) -> int:
    """A run's facts, its scopes' cursors, and a row for each window and for the run, in one commit; the new version.

    log: tables facts, scopes, windows and runs. windows: chain_id, address, start, end, target_block; the own facts that
    they held before are replaced by ``fresh``, others stay. Whatever fails before the last step leaves the old state of
    all four; Conflict where another run was committed since.
    """
    now = log.snapshot()
    scope = F.pmod(F.xxhash64("chain_id", "address"), F.lit(SCOPE_BUCKETS)).cast("string")
    names = lambda rows, c: {r[0] for r in rows.select(c.cast("string")).distinct().collect()}  # noqa: E731  of buckets
    span = windows.select("chain_id", F.explode(F.sequence(F.floor(F.col("start") / WIDTH), F.floor(F.col("end") / WIDTH))).alias("k")).select("chain_id", (F.col("k") * WIDTH).alias("block"))
    touched, near = names(span, bucket), names(windows, scope)
    old = log.read("facts", now, touched)
    old = old.select(*fresh.columns) if old is not None else fresh.limit(0)
    sizes = fresh.select(bucket.alias("b")).unionByName(old.select(bucket.alias("b"))).groupBy("b").count().collect()  # a row a bucket
    place = lambda rows: placed(rows, bucket, KEY, splits(r["count"] for r in sizes))
    facts = replace_overlap(old, fresh, windows, source, place)
    held = log.read("scopes", now, near)
    held = windows.sparkSession.createDataFrame([], SCOPES) if held is None else held
    asked = windows.groupBy("chain_id", "address").agg(F.max("target_block").alias("__target"))
    both = held.join(asked, ["chain_id", "address"], "full")
    scopes = commit(both.withColumn("target_block", F.coalesce("__target", "target_block")).drop("__target"), windows).withColumn("status", F.coalesce(F.when(F.col("next_block") > F.col("target_block"), "idle"), F.lit("behind"))).select(*held.columns)
    told = windows.select("chain_id", "address", "start", "end", F.lit(run_id).alias("run_id"))
    runs = run_rows(windows, run_id).join(fresh.groupBy("chain_id", "address").agg(F.count("*").alias("records")), ["chain_id", "address"], "left")
    day = F.lit("all")
    written = {"facts": (fresh.schema, dict.fromkeys(touched, []) | log.write("facts", facts, bucket)), "scopes": (scopes.schema, log.write("scopes", scopes, scope))}
    added = {"windows": (told.schema, log.write("windows", told, day)), "runs": (runs.schema, log.write("runs", runs, day))}
    return log.commit(now, written, added)


def status(requests: DataFrame, scopes: DataFrame, key: list[str]) -> DataFrame:
    """Control row of each scope asked for, each request once; columns are null where a scope was never synced."""
    return requests.select(*key).distinct().join(scopes, key, "left")


def run_rows(windows: DataFrame, run_id: str, code: Column | None = None) -> DataFrame:
    """A ledger row for each window tried: complete, or failed with a code."""
    why = code if code is not None else F.lit(None).cast("string")
    return windows.select(F.lit(run_id).alias("run_id"), "chain_id", "address", "start", "end", F.when(why.isNull(), "complete").otherwise("failed").alias("status"), why.alias("code"))


def replay_trigger(pending: DataFrame, touched: DataFrame) -> DataFrame:
    """Replay requests merged by account: the smaller from_block and the larger to_block."""
    return pending.unionByName(touched).groupBy("chain_id", "address").agg(F.min("from_block").alias("from_block"), F.max("to_block").alias("to_block"))


def audit(scopes: DataFrame, facts: DataFrame, snapshots: DataFrame | None = None) -> DataFrame:
    """One row for each scope: facts, gaps, duplicates, whether the cursor follows the last block, replay coverage, status."""
    scope = ["chain_id", "address"]
    counts = facts.groupBy(*scope, "identity").agg(F.count("*").alias("n")).groupBy(*scope).agg(F.sum("n").alias("facts"), F.sum(F.col("n") - 1).alias("duplicates"))
    holes = gaps(facts, scope).groupBy(*scope).agg(F.count("*").alias("gaps"))
    rows = scopes.join(counts, scope, "left").join(holes, scope, "left")
    rows = rows.join(snapshots.groupBy(*scope).agg(F.max("block").alias("replayed_to")), scope, "left") if snapshots is not None else rows.withColumn("replayed_to", F.lit(None).cast("bigint"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    rows = rows.select(*scope, "next_block", "last_complete_block", zero("facts"), zero("duplicates"), zero("gaps"), "replayed_to")
    rows = rows.withColumn("cursor_ok", F.coalesce(F.col("next_block") == F.col("last_complete_block") + 1, F.col("next_block").isNull()))
    return rows.withColumn("status", F.when((F.col("duplicates") == 0) & (F.col("gaps") == 0) & F.col("cursor_ok"), "ok").otherwise("attention"))


def write_buckets(facts: DataFrame, path: str, width: int = 100_000) -> None:
    """Writes only the (chain_id, block_bucket) partitions that facts touch, sorted for pruning; others survive."""
    rows = facts.withColumn("block_bucket", (F.col("block") / width).cast("bigint"))
    near = rows.repartitionByRange("chain_id", "block_bucket", "address")
    near.sortWithinPartitions("chain_id", "block_bucket", "address", "block").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chain_id", "block_bucket").parquet(path)


def read_buckets(spark: SparkSession, path: str, first: int | None = None, last: int | None = None, width: int = 100_000) -> DataFrame:
    """Facts of a block range; whole buckets outside it are not read."""
    rows = spark.read.parquet(path)
    if first is not None:
        rows = rows.filter(F.col("block_bucket").between(first // width, last // width) & F.col("block").between(first, last))
    return rows.drop("block_bucket")
