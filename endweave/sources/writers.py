"""Sinks: tables, positions, annotation files, tracks and manifests."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, null: str = "NA") -> None:
    """Tab-separated text with a header; nested columns must be joined before."""
    df.write.mode("overwrite").csv(path, sep="\t", header=True, nullValue=null, emptyValue="")


def write_positions(ends: DataFrame, path: str) -> None:
    """Position counts as Parquet, a folder for each sample, in files of ranges of places, sorted inside."""
    places = "sample_id", "chrom", "pos", "strand"
    ordered = ends.repartitionByRange(*places).sortWithinPartitions(*places)
    ordered.write.mode("overwrite").partitionBy("sample_id").parquet(path)


def write_bam(alignments: DataFrame, path: str, contigs: list[tuple[str, int]]) -> None:
    """Alignments (read_name, flag, chrom, ref_start, cigar, nh) as BAM files, one a task, without bases."""
    from endweave.sources import bam

    bam.register(alignments.sparkSession)
    none = {"ref_end": F.lit(None).cast("long"), "file": F.lit(None).cast("string")}
    rows = alignments.select("read_name", "flag", "chrom", "ref_start", none["ref_end"].alias("ref_end"), "cigar", "nh", none["file"].alias("file"))
    rows.write.format("bam").option("contigs", json.dumps(contigs)).mode("append").save(path)


def as_saf(union: DataFrame) -> DataFrame:
    """1-based inclusive intervals for counting tools."""
    return union.select(F.col("gene_id").alias("GeneID"), F.col("chrom").alias("Chr"), (F.col("start") + 1).alias("Start"), F.col("end").alias("End"), F.col("strand").alias("Strand"))


def as_bed(union: DataFrame) -> DataFrame:
    return union.select("chrom", "start", "end", "gene_id", F.lit(0).alias("score"), "strand")


def write_bed(df: DataFrame, path: str) -> None:
    """One sorted part, without header: what genome browsers take."""
    df.orderBy("chrom", "start", "end").coalesce(1).write.mode("overwrite").csv(path, sep="\t")


def write_bedgraph(signal: DataFrame, path: str) -> None:
    """Tracks by sample and strand; inside, intervals in contig order with twelve digits at most."""
    # Twelve digits always have a point, so that only zeros behind it go.
    digits = F.regexp_replace(F.format_string("%.12g", "value"), r"\.?0+(e|$)", "$1")
    text = F.concat(F.format_string("%s\t%d\t%d\t", "chrom", "start", "end"), digits)
    rows = signal.withColumn("text", text).repartition("sample_id", "strand").sortWithinPartitions("sample_id", "strand", "ordinal", "start")
    rows.select("sample_id", "strand", "text").write.mode("overwrite").partitionBy("sample_id", "strand").text(path)


def merged(fragments: list[DataFrame]) -> DataFrame:
    """Fragments below each other; different columns are an error."""
    out = fragments[0]
    for part in fragments[1:]:
        if part.columns != out.columns:
            raise ValueError(f"columns differ: {part.columns} and {out.columns}")
        out = out.unionByName(part)
    return out


def content_digest(df: DataFrame) -> str:
    """A digest of a table's rows, the same for any order and partitioning."""
    # Nulls don't change a hash: which columns are null is hashed as well.
    names = sorted(df.columns)
    row = F.xxhash64(F.concat_ws("", *[F.col(c).isNull().cast("int").cast("string") for c in names]), *[F.col(c).cast("string") for c in names])
    total = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row.cast("decimal(38,0)")).alias("s"), F.bit_xor(row).alias("x")).first()
    return hashlib.sha256(f"{total['n']}/{total['s']}/{total['x']}".encode()).hexdigest()


def folder_digest(spark: SparkSession, folder: str) -> str:
    """Of the names, sizes and times of all files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return content_digest(files.select("path", "length", "modificationTime"))


def signature(parameters: dict, inputs: dict[str, str]) -> str:
    """Of parameters and inputs' digests, whatever their order."""
    return hashlib.sha256(json.dumps({"parameters": parameters, "inputs": inputs}, sort_keys=True).encode()).hexdigest()


def receipt(df: DataFrame, step: str, key: str) -> DataFrame:
    """A one-row manifest of a step's output: (step, signature, rows, digest)."""
    return df.sparkSession.createDataFrame([(step, key, df.count(), content_digest(df))], "step string, signature string, rows long, digest string")


def still_valid(manifest: DataFrame, step: str, key: str, df: DataFrame) -> bool:
    """Whether a manifest has the step with this signature and the table is as it was then."""
    found = manifest.filter((F.col("step") == step) & (F.col("signature") == key)).select("digest").head()
    return bool(found) and found["digest"] == content_digest(df)
