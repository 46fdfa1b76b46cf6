"""Structured Streaming on the batch functions (survey 2.12)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerlake.functions import u256
from ledgerlake.operators import maintenance
from ledgerlake.operators.commits import PLACE, CommitLog, Conflict, placed, splits
from ledgerlake.operators.ledger import watched
from ledgerlake.operators.prices import SCOPE


def landing(spark: SparkSession, path: str, schema: StructType, files: int = 1000, form: str = "json") -> DataFrame:
    """Stream over a landing zone; each micro-batch takes at most ``files`` files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(form).load(path)


def run_available(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Works off what has landed, from where the checkpoint left off."""
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: Blocks of one chain that a bucket of a table holds.
WIDTH = maintenance.WIDTH
#: How often a batch is merged anew where another writer came first.
TRIES = 5


def block_bucket() -> Column:
    return F.concat_ws("-", "chain_id", F.floor(F.col("block") / WIDTH).cast("bigint"))


class FactSink:
    """Keyed upserts of micro-batches into a table in buckets, of which a batch rewrites those that it touches.

    Each batch is one commit of a :class:`commits.CommitLog`, whose versions grow on their own; with it goes the batch's
    id, and a batch that its stream applied before changes nothing, whichever streams write the table. A stream is told by Spark's
    query id, which stays the same over restarts from a checkpoint; calls from outside a stream are told by ``query``, or
    else by the sink. Of two writers that meet, one merges anew. Facts are merged within their bucket, so an identity that
    moves between buckets needs its old window collected anew.

    With a ``key``, ``merge`` is told by ``place`` how to deal rows to the tasks that write them, so that a batch is one shuffle.
    ``first`` reduces a batch, which is then computed once and held until it is merged.
    """

    TABLE = "facts"

    def __init__(self, path: str, merge: Callable[..., DataFrame], bucket: Column | None = None, key: list[str] | None = None, first: Callable[[DataFrame], DataFrame] | None = None):
        self.path, self.merge, self.bucket, self.own = path, merge, block_bucket() if bucket is None else bucket, uuid.uuid4().hex
        self.key, self.first = key, first

    def log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, self.path)

    def versions(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """bucket and v, the commit that wrote each bucket last, of commits before one."""
        since = self.log(spark).snapshot(None if before is None else before - 1).since.get(self.TABLE, {})
        return spark.createDataFrame(sorted(since.items()), "bucket string, v bigint")

    def read(self, spark: SparkSession, before: int | None = None, buckets: set[str] | None = None) -> DataFrame | None:
        """The table, or its facts in some buckets, as of the commits before one; files of other buckets are not listed."""
        log = self.log(spark)
        return log.read(self.TABLE, log.snapshot(None if before is None else before - 1), buckets)

    def touched(self, batch: DataFrame, windows: DataFrame | None = None) -> dict[str, int]:
        """Buckets of the facts of a batch, and of the blocks of its windows, with the number of facts."""
        found = batch.select(self.bucket.alias("bucket"), F.lit(1).alias("n"))
        if windows is not None:
            starts = F.array_distinct(F.transform(F.sequence(F.floor(F.col("start") / WIDTH), F.floor(F.col("end") / WIDTH)), lambda k: k * WIDTH))
            found = found.unionByName(windows.select("chain_id", F.explode(starts).alias("block")).select(self.bucket.alias("bucket"), F.lit(0).alias("n")))
        return {r.bucket: r.n for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # names of buckets, not facts

    def __call__(self, batch: DataFrame, batch_id: int, *more: DataFrame, query: str | None = None) -> None:
        spark = batch.sparkSession
        log, stream = self.log(spark), query or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or self.own
        if log.snapshot().applied.get(stream, -1) >= batch_id:
            return
        if self.first is None:
            return self._merge(log, stream, batch, batch_id, *more)
        held = batch.persist()
        held.count()  # before the steps that read it, which run side by side and may each compute it in another machine
        small = self.first(held).persist()
        try:
            return self._merge(log, stream, small, batch_id, *more)
        finally:
            small.unpersist()
            held.unpersist()

    def _merge(self, log: CommitLog, stream: str, batch: DataFrame, batch_id: int, *more: DataFrame) -> None:
        touched = self.touched(batch, *more)
        for _ in range(TRIES):
            now = log.snapshot()
            if now.applied.get(stream, -1) >= batch_id:
                return
            old = log.read(self.TABLE, now, set(touched))
            old = old.select(*batch.columns) if old is not None else batch.limit(0)
            held = {r.bucket: r["count"] for r in old.groupBy(self.bucket.alias("bucket")).count().collect()}  # a row a bucket
            n = splits(x + held.get(b, 0) for b, x in touched.items())
            place = {"place": lambda rows: placed(rows, self.bucket, self.key, n)} if self.key else {}  # noqa: B023
            rows = self.merge(old, batch, *more, **place)
            parts = dict.fromkeys(touched, []) | log.write(self.TABLE, rows, self.bucket)
            try:
                log.commit(now, {self.TABLE: (batch.schema, parts)}, batch=(stream, batch_id))
                return
            except Conflict:
                continue
        raise Conflict(f"{TRIES} others came first")


class AppendSink(FactSink):
    """Rows of micro-batches as they come, for streams that publish each once: no bucket is read, merged or written anew.

    Each batch is one commit, with its id, as of a :class:`FactSink`; it is computed once and not shuffled.
    """

    def __init__(self, path: str):
        super().__init__(path, lambda old, new: new, F.lit("all"))

    def _merge(self, log: CommitLog, stream: str, batch: DataFrame, batch_id: int, *more: DataFrame) -> None:
        parts = log.write(self.TABLE, batch.withColumns({PLACE[0]: self.bucket, PLACE[1]: F.lit(0)}), self.bucket)
        for _ in range(TRIES):
            now = log.snapshot()
            if now.applied.get(stream, -1) >= batch_id:
                return
            try:
                log.commit(now, {}, {self.TABLE: (batch.schema, parts)}, batch=(stream, batch_id))
                return
            except Conflict:
                continue
        raise Conflict(f"{TRIES} others came first")


def upsert_sink(path: str, key: list[str] | None = None, bucket: Column | None = None) -> FactSink:
    return FactSink(path, lambda old, new, place: maintenance.upsert(old, new, key, place), bucket, key or maintenance.KEY)


def overlap_sink(path: str, source: str) -> FactSink:
    """Late and reorganised data: the windows that were collected replace what their source said of them before.

    Called with a batch, its id and windows (chain_id, address, start, end; any number for an account), those that were
    collected, whether facts came or not. Without windows a batch replaces the blocks it has facts of, and no others.
    Facts outside the windows are upserted.
    """

    def merge(old: DataFrame, new: DataFrame, windows: DataFrame | None = None, *, place: Callable[[DataFrame], DataFrame]) -> DataFrame:
        if windows is None:
            windows = new.select("chain_id", "address", F.col("block").alias("start"), F.col("block").alias("end")).distinct()
        return maintenance.upsert(maintenance.left_over(old, windows, source), new, place=place)

    return FactSink(path, merge, key=maintenance.KEY)


def price_sink(path: str) -> FactSink:
    """Price points in buckets of a day."""
    return upsert_sink(path, [*SCOPE, "ts"], F.to_date("ts").cast("string"))


def without_repeats(stream: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Append-only facts: an identity met again within ``delay`` is dropped, and its state with it."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["chain_id", "address", "identity"])


def running_balances(transfers: DataFrame) -> DataFrame:
    """Balance limbs of every account and token so far; for update mode. Interest settlement is left to the batch jobs."""
    sides = watched(transfers)
    amount = u256.parse(F.col("amount"))
    net = [F.when(F.col("to_address") == F.col("address"), amount[p]).otherwise(0) - F.when(F.col("from_address") == F.col("address"), amount[p]).otherwise(0) for p in u256.PARTS]
    return sides.groupBy("chain_id", "address", "token_address").agg(*[F.sum(x).alias(p) for x, p in zip(net, u256.PARTS, strict=True)])


def published_balances(transfers: DataFrame, delay: str = "1 minute") -> DataFrame:
    """What each account's holding of a token changed by in a block, published once the watermark has passed it.

    For append mode: a block's row appears once, when no more of its facts can come. address, token_address, block, the
    block's time and the change in limbs; :func:`ledger.running_sums` of them are the account's states.
    """
    timed = transfers.withWatermark("ts", delay)
    amount = u256.parse(F.col("amount"))
    sides = watched(timed)
    net = [F.sum(F.when(F.col("to_address") == F.col("address"), amount[p]).otherwise(0) - F.when(F.col("from_address") == F.col("address"), amount[p]).otherwise(0)).alias(p) for p in u256.PARTS]
    return sides.groupBy(F.window("ts", "1 minute"), "chain_id", "address", "token_address", "block").agg(F.count("*").alias("transfers"), *net)


def complete_blocks(transfers: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Sums of blocks, published once the watermark has passed the block's minute; for append mode."""
    amount = u256.parse(F.col("amount"))
    timed = transfers.withWatermark("ts", delay)
    return timed.groupBy(F.window("ts", "1 minute"), "chain_id", "token_address", "block").agg(F.count("*").alias("transfers"), *[F.sum(amount[p]).alias(p) for p in u256.PARTS])


def replay_requests(batch: DataFrame) -> DataFrame:
    """from_block and to_block of each account that a micro-batch touches."""
    return batch.groupBy("chain_id", "address").agg(F.min("block").alias("from_block"), F.max("block").alias("to_block"))


def monitor(scopes: DataFrame, facts: DataFrame, batch: DataFrame) -> DataFrame:
    """Audit of the scopes that a micro-batch touches."""
    touched = batch.select("chain_id", "address").distinct()
    return maintenance.audit(scopes.join(touched, ["chain_id", "address"], "left_semi"), facts.join(touched, ["chain_id", "address"], "left_semi"))
