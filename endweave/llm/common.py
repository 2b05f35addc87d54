"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from endweave.session import cut, ensure_checkpoint_dir  # noqa: F401

#: Word pattern and white space of the contracts: ASCII space and 0x09-0x0D.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of a table that is broadcast, at most.
NEAR_BYTES = 16 << 20


def nearby(df: DataFrame, most: int = NEAR_BYTES) -> DataFrame:
    """A table that is written already, to be joined to a wide one: broadcast if it has at most ``most``
    bytes, so that the wide one needn't move; beyond that Spark shuffles both."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    texts += [8 * F.coalesce(F.size(c), F.lit(0)) for c, kind in df.dtypes if kind.startswith("array")]
    width = sum(texts, F.lit(8 * (len(df.columns) + 1)))
    size = df.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= most else df


def dealt_anew(df: DataFrame, key: str) -> DataFrame:
    """An aggregate by ``key`` that a join deals out again: if it were joined where it lies, Spark
    could not split the partitions of frequent keys on the other side."""
    return df.withColumn(key, F.col(key).bitwiseXOR(F.lit(0).cast("long")))


def delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def bucketed(df: DataFrame, key: str) -> Iterator[DataFrame]:
    """df written in buckets of ``key`` to the shared checkpoint folder, for joins that read it again and
    again where it lies; the table and its files go at the end."""
    spark, name = df.sparkSession, f"endweave_{uuid.uuid4().hex}"
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}"
    n = partitions(spark)
    try:
        df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("path", folder).saveAsTable(name)
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete(spark, folder)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def columns_of(df: DataFrame, *names: str) -> DataFrame:
    """Only these columns: further columns of the input, whatever their names, play no part."""
    return df.select(*[df[name] for name in names])
