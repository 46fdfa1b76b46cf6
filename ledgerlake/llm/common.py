"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.lineage import shared_dir

#: Rows of an Arrow batch that are worked on at once, and their bytes (unless it is one row); bounds what a task holds.
SLICE, SLICE_BYTES = 1000, 16_000_000
#: Rows of one key from which it is joined apart, and such keys that are broadcast at most (some 100 bytes each).
HOT, MOST_HOT = 1000, 100_000
#: Spark's setting that removes a query's shuffle files when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stash(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends here, and a lost executor costs no rework."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true")  # once written, what was shuffled for the table is of no more use
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def forget(table: DataFrame) -> None:
    """Removes the files of a stashed table that nothing reads any more."""
    jvm, files = table.sparkSession._jvm, table.inputFiles()
    if files:
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def ids_repeat(docs: DataFrame) -> bool:
    """Whether a doc_id is null or that of several rows."""
    return not docs.groupBy("doc_id").count().filter("count > 1 or doc_id is null").isEmpty()


def tid_of(docs: DataFrame, repeat: bool | None = None) -> Column:
    """What tells rows of one doc_id apart: a hash of the text, or zero, which costs nothing to carry along, where no id is null or repeated."""
    return F.xxhash64("text") if (ids_repeat(docs) if repeat is None else repeat) else F.lit(0).cast("bigint")


def keyed(docs: DataFrame, tid: Column | None = None) -> DataFrame:
    """doc_id, tid and the text's bytes. Rows that agree in doc_id and text are one document; tid tells other rows apart."""
    return docs.select("doc_id", (F.xxhash64("text") if tid is None else tid).alias("tid"), F.col("text").cast("binary").alias("text"))


def same_doc(a: DataFrame, b: DataFrame) -> Column:
    """Join condition on the key of :func:`keyed`; null ids are equal to each other."""
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["tid"] == b["tid"])


def join_counted(rows: DataFrame, groups: DataFrame, key: list[str], count: str) -> DataFrame:
    """``rows`` joined to ``groups`` (key, ``count``, the rows that a key has, and more), with keys that have very many apart.

    Keys of over HOT rows are broadcast, so that their rows stay where they are; all others are joined by a shuffle.
    Where more keys than MOST_HOT have so many rows, only those with still more are broadcast.
    """
    least, n = HOT, groups.filter(F.col(count) > HOT).count()
    while n > MOST_HOT:
        least *= 10
        n = groups.filter(F.col(count) > least).count()
    if not n:
        return rows.join(groups, key)
    few = groups.filter(F.col(count) > least)
    rest = rows.join(F.broadcast(few.select(*key)), key, "left_anti").join(groups.filter(F.col(count) <= least), key)
    return rows.join(F.broadcast(few), key).unionByName(rest)


def slices(batch: pa.RecordBatch, rows: int = SLICE, size: int | None = None) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of at most ``rows`` rows and, where they have several, ``size`` bytes (SLICE_BYTES)."""
    size = SLICE_BYTES if size is None else size
    for at in range(0, batch.num_rows, rows):
        piece = batch.slice(at, rows)
        while piece.num_rows > 1 and piece.nbytes > size:
            half = piece.num_rows // 2
            while half > 1 and piece.slice(0, half).nbytes > size:
                half //= 2
            yield piece.slice(0, half)
            piece = piece.slice(half)
        yield piece


def shards(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of a task in shards of at most ``rows``, each with a number that no other shard of the job has."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for piece in slices(batch, rows):
            yield number, piece
            number += 1


def by_slice(work: Callable[[pa.RecordBatch], pa.RecordBatch | None], rows: int = SLICE, size: int | None = None, after: Callable[[], None] | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` as a function for mapInArrow, given slices of at most ``rows`` rows, bounded in bytes too (``size``); ``after`` is called at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, rows, size):
                out = work(piece)
                if out is not None:
                    yield out
        if after is not None:
            after()
        give_back()

    return run


def give_back() -> None:
    """Returns what a task has freed to the system, since a worker may sit idle beside others from then on."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_libc(), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


@lru_cache(maxsize=1)
def _libc() -> ctypes.CDLL:
    return ctypes.CDLL(None)


def is_in_fold(modulus: int, remainder: int) -> Column:
    """Whether crc32 of doc_id as text leaves ``remainder``; a null id leaves none."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))
