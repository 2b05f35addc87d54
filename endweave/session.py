"""Checkpoints in the folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a narrow table that are handed to every task.
NEAR_ROWS = 200_000


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the folder of spark.checkpoint.dir; sets one only where none is named, as in tests."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = sc.getConf().get("spark.checkpoint.dir")
    if not named and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="endweave-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared checkpoint folder and goes on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """As ``cut``, in columns: for long tables that are read again, of which a step takes what it needs."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/columns-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def nearby(df: DataFrame) -> DataFrame:
    """A narrow table, written in columns, to be joined to a long one: broadcast with at most NEAR_ROWS rows, so
    that the long one need not move; beyond that both are dealt out, and this one is the hashed side."""
    rows = written(df)
    return F.broadcast(rows) if rows.count() <= NEAR_ROWS else rows.hint("shuffle_hash")
