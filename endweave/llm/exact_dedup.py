"""Exact dedup by content sort.

Normalised texts are range-partitioned by sampled splitters, sorted externally inside each
range, and every run of neighbours that compare equal over all their bytes keeps its row with
the smallest identifier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from endweave.llm.common import SPACE, columns_of, cut, partitions, text_or_empty

#: Leading characters in the sampled sort key. Splitters stay small however long the texts are; the
#: 64-bit hash behind them orders texts with the same beginning, and the whole text decides.
LEAD = 32


def normalised(column: str = "text"):
    return F.regexp_replace(text_or_empty(column), SPACE, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, n_bytes.

    A null text counts as the empty text, and empty texts are equal to each other. Of rows with
    the same text and the same id only one is kept, if it is the smallest id of the group; a null
    id is larger than any other, so that keep_id is null only where every id of the group is.
    An empty table gives an empty result. Columns other than the two named are not read.

    A text that holds more than 1/(4P) of all rows, P being the number of shuffle partitions, is
    dealt to several sub-runs; at most 4P texts can be that frequent, so that the list of them is
    small whatever the input. Sub-runs are then put together by their whole text again.
    """
    spark = docs.sparkSession
    p = partitions(spark)
    norm = columns_of(docs, id_col, text_col).select(
        F.col(id_col).alias("id"), normalised(text_col).alias("norm")
    )
    norm = norm.withColumn("h", F.xxhash64("norm"))
    total = max(docs.count(), 1)
    hot = (
        norm.groupBy("h")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") * (4 * p) > total)
        .select("h", F.ceil(F.col("n") * (2 * p) / F.lit(total)).cast("int").alias("parts"))
    )
    hot = cut(hot)  # at most 4P rows
    keyed = norm.join(F.broadcast(hot), "h", "left").select(
        "id",
        "norm",
        "h",
        F.substring("norm", 1, LEAD).alias("lead"),
        F.when(F.col("parts").isNull(), -1)
        .otherwise(F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        .alias("part"),
    )
    # The window's keys contain the range's keys, so that it needs no further exchange: it reads
    # the sorted range and compares each text with its neighbour.
    run = Window.partitionBy("lead", "h", "part", "norm").orderBy(F.col("id").asc_nulls_last())
    whole_run = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranged = (
        keyed.repartitionByRange(p, "lead", "h", "part")
        .withColumn("run_min", F.min("id").over(whole_run))
        .withColumn("run_size", F.count(F.lit(1)).over(whole_run))
        .withColumn("run_rank", F.row_number().over(run))
        .select(
            "id",
            "part",
            "h",
            F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
            F.octet_length("norm").cast("long").alias("n_bytes"),
            "run_min",
            "run_size",
            "run_rank",
            F.when((F.col("part") >= 0) & (F.col("run_rank") == 1), F.col("norm")).alias("norm"),
        )
    )
    ranged = cut(ranged)
    heads = ranged.filter("part >= 0 and run_rank = 1")
    merged = (
        heads.groupBy("norm")
        .agg(
            F.first("text_sha256").alias("text_sha256"),
            F.min("run_min").alias("all_min"),
            F.sum("run_size").alias("all_size"),
            F.min_by("part", F.struct(F.col("run_min").isNull(), "run_min", "part")).alias("all_part"),
        )
        .select("text_sha256", "all_min", "all_size", "all_part")
    )
    whole = ranged.drop("norm").join(F.broadcast(merged), "text_sha256", "left")
    return whole.select(
        F.col("id").alias(id_col),
        F.coalesce("all_min", "run_min").alias("keep_id"),
        F.coalesce("all_size", "run_size").cast("long").alias("group_size"),
        ((F.col("run_rank") == 1) & (F.coalesce("all_part", "part") == F.col("part"))).alias("kept"),
        "text_sha256",
        "n_bytes",
    )
