"""Known-site sources: validity, first-wins dedup, lift-over, clusters and consensus records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from endweave.operators.intervals import gap_clusters

PLACE = ["chrom", "strand"]


def rejected(records: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds ``reason``: why a record (chrom, pos, flagged) is unfit, null if it is not."""
    joined = records.join(sizes.select("chrom", "size"), "chrom", "left")
    reason = (
        F.when(F.col("flagged"), "internal_priming_flag")
        .when(F.col("size").isNull(), "unknown_contig")
        .when((F.col("pos") < 0) | (F.col("pos") >= F.col("size")), "out_of_bounds")
    )
    return joined.withColumn("reason", reason).drop("size")


def first_of(records: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """The first record of each key by an explicit ordinal."""
    order = Window.partitionBy(*keys).orderBy(ordinal)
    return records.withColumn("r_", F.row_number().over(order)).filter("r_ = 1").drop("r_")


def lifted(records: DataFrame, mapping: DataFrame) -> DataFrame:
    """Adds where a record (source_id, strand) goes, or why not: mapping has source_id, to_chrom, to_pos, to_strand."""
    per = mapping.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("to_chrom", "to_pos", "to_strand")).alias("t"))
    joined = records.join(per, "source_id", "left")
    status = F.when(F.col("n").isNull(), "unmapped").when(F.col("n") > 1, "multiple").when(F.col("t.to_strand") != F.col("strand"), "strand_changed").otherwise("lifted")
    ok = status == "lifted"
    return joined.select(*records.columns, status.alias("status"), F.when(ok, F.col("t.to_chrom")).alias("to_chrom"), F.when(ok, F.col("t.to_pos")).alias("to_pos"))


def consensus(records: DataFrame, gap: int = 10, preferred: tuple[str, ...] = ("MainDB", "GENCODE")) -> DataFrame:
    """One record for each cluster (source, source_id, pos): the smallest position of the preferred
    source, its tier and confidence, its sources and ids."""
    parts = gap_clusters(records, PLACE, "pos", gap)
    best = F.coalesce(*[F.min(F.when(F.col("source") == s, F.col("pos"))) for s in preferred], F.min("pos"))
    core = F.bool_or(F.col("source").isin(*preferred))
    both = F.bool_and(F.lit(True))
    for s in preferred:
        both = both & F.bool_or(F.col("source") == s)
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ";")
    return parts.groupBy(*PLACE, "cluster").agg(
        best.alias("pos"),
        F.when(core, "core").otherwise("rescue").alias("tier"),
        F.when(both, "A").when(core, "B").otherwise("C").alias("confidence"),
        listed("source").alias("sources"),
        listed("source_id").alias("source_ids"),
        F.count(F.lit(1)).alias("members"),
    ).drop("cluster")


def weighted_clusters(candidates: DataFrame, gap: int = 24) -> DataFrame:
    """Candidates (pos, sample_id, weight, level, repeat) merged by gaps: the position of the most weight,
    the distal one of ties."""
    places = candidates.groupBy(*PLACE, "pos").agg(
        F.sum("weight").alias("weight"), F.collect_set("level").alias("levels"), F.bool_or("repeat").alias("repeat")
    )
    parts = gap_clusters(places, PLACE, "pos", gap)
    distal = F.when(F.col("strand") == "+", F.col("pos")).otherwise(-F.col("pos"))
    return parts.groupBy(*PLACE, "cluster").agg(
        F.max_by("pos", F.struct("weight", distal)).alias("pos"),
        F.sum("weight").cast("long").alias("weight"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("levels")))), ";").alias("levels"),
        F.bool_or("repeat").alias("repeat"),
    ).drop("cluster")


def build(records: DataFrame, mapping: DataFrame, sizes: DataFrame, gap: int = 10) -> tuple[DataFrame, DataFrame]:
    """(atlas, audit) of an older assembly's records (source, source_id, chrom, strand, pos, flagged): lifted,
    held against the contigs, each source's places once, and clustered. The audit says how many records of
    a source ended where (source, outcome, records)."""
    moved = lifted(records, mapping)
    there = moved.filter("status = 'lifted'").select("source", "source_id", F.col("to_chrom").alias("chrom"), "strand", F.col("to_pos").alias("pos"), "flagged")
    judged = rejected(there, sizes)
    fit = judged.filter("reason is null")
    places = fit.groupBy("source", *PLACE, "pos").agg(F.min("source_id").alias("source_id"), F.count(F.lit(1)).alias("n"))
    outcome = lambda df, what, n: df.groupBy("source", what.alias("outcome")).agg(n.cast("long").alias("records"))
    audit = (
        outcome(moved.filter("status <> 'lifted'"), F.col("status"), F.count(F.lit(1)))
        .union(outcome(judged.filter("reason is not null"), F.col("reason"), F.count(F.lit(1))))
        .union(outcome(places, F.lit("kept"), F.count(F.lit(1))))
        .union(outcome(places, F.lit("repeated"), F.sum(F.col("n") - 1)))
    )
    return consensus(places.drop("n"), gap), audit.filter("records > 0")
