"""Where lineage is cut: results that several steps read are written once to the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a local session, where all run in one machine, may leave it unset and gets a folder of its own.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    if found.isDefined():
        return found.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    made = "file://" + tempfile.mkdtemp(prefix="ledgerlake-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed now and kept as a checkpoint, so that steps that read it several times do not plan or compute it anew."""
    spark = df.sparkSession
    place = shared_dir(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(place)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet, for wide results: a few columns or a range of blocks are then read at the cost of these."""
    at = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
