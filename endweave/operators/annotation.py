"""Extended gene models, exon unions, read counting, coverage and tracks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from endweave.operators.intervals import BIN, coverage, merge, overlaps

PLACE = ["chrom", "strand"]


def exon_union(exons: DataFrame) -> DataFrame:
    """Merged exons of each gene: gene_id, chrom, strand, start, end."""
    return merge(exons.select("gene_id", *PLACE, "start", "end"), ["gene_id", *PLACE], adjacent=True).drop("members")


def barriers(genes: DataFrame, starts: DataFrame, sizes: DataFrame, buffer: int) -> DataFrame:
    """What an extension must not enter: other bodies, and the buffers upstream of transcription starts
    (gene_id, chrom, strand, tss)."""
    bodies = genes.select(*PLACE, "gene_id", "start", "end", F.lit("other_gene_body").alias("reason"))
    plus = F.col("strand") == "+"
    zones = starts.join(sizes, "chrom").select(
        *PLACE,
        "gene_id",
        F.when(plus, F.greatest(F.lit(0), F.col("tss") - buffer + 1)).otherwise(F.col("tss") + 1).alias("start"),
        F.when(plus, F.col("tss")).otherwise(F.least("size", F.col("tss") + buffer)).alias("end"),
        F.lit("tss_buffer").alias("reason"),
    )
    return bodies.union(zones.filter("start < end"))


def requested(genes: DataFrame, exons: DataFrame, sizes: DataFrame, extension: int) -> DataFrame:
    """(gene_id, chrom, strand, anchor, start, end, reason) of the full extension, cut at the contig's edges."""
    anchors = exons.groupBy("gene_id").agg(F.max("end").alias("last"), F.min("start").alias("first"))
    plus = F.col("strand") == "+"
    out = genes.select("gene_id", *PLACE).join(anchors, "gene_id").join(sizes, "chrom")
    out = out.withColumn("anchor", F.when(plus, F.col("last")).otherwise(F.col("first")))
    out = out.withColumn("start", F.when(plus, F.col("anchor")).otherwise(F.greatest(F.lit(0), F.col("anchor") - extension)))
    out = out.withColumn("end", F.when(plus, F.least("size", F.col("anchor") + extension)).otherwise(F.col("anchor")))
    full = F.col("end") - F.col("start") == extension
    return out.select("gene_id", *PLACE, "anchor", "start", "end", F.when(full, "full_cap").otherwise("chromosome_edge").alias("reason"))


def clip(extensions: DataFrame, blocks: DataFrame, width: int = BIN) -> DataFrame:
    """Cuts each extension at the nearest block (gene_id, reason) of another gene, that of the smallest
    gene id and reason of several equally near; adds limiting_gene."""
    spans = extensions.filter("start < end")
    hit = overlaps(spans, blocks.select(*PLACE, "gene_id", "start", "end", "reason"), PLACE, width).filter("gene_id <> o_gene_id")
    plus = F.col("strand") == "+"
    near = F.when(plus, F.greatest("start", "o_start")).otherwise(-F.least("end", "o_end"))
    nearest = hit.groupBy("gene_id").agg(F.min(F.struct(near.alias("at"), F.col("o_gene_id").alias("by"), F.col("o_reason").alias("why"))).alias("b"))
    out = extensions.join(nearest, "gene_id", "left")
    at = F.when(plus, F.greatest("start", F.col("b.at"))).otherwise(F.least("end", -F.col("b.at")))
    found = F.col("b").isNotNull()
    return out.select(
        *[c for c in extensions.columns if c not in ("start", "end", "reason", "limiting_gene")],
        F.when(found & ~plus, at).otherwise(F.col("start")).alias("start"),
        F.when(found & plus, at).otherwise(F.col("end")).alias("end"),
        F.coalesce("b.why", "reason").alias("reason"),
        F.coalesce("b.by", F.col("limiting_gene") if "limiting_gene" in extensions.columns else F.lit("")).alias("limiting_gene"),
    )


def clip_conflicts(extensions: DataFrame, width: int = BIN) -> DataFrame:
    """Cuts extensions against each other, all against the lengths they have before."""
    blocks = extensions.filter("start < end").select(*PLACE, "gene_id", "start", "end", F.lit("extension_conflict").alias("reason"))
    return clip(extensions, blocks, width)


def opposite_overlaps(extensions: DataFrame, genes: DataFrame, width: int = BIN) -> DataFrame:
    """(gene_id, overlaps): ids of the genes on the other strand that an extension runs into."""
    other = F.when(F.col("strand") == "+", "-").otherwise("+")
    bodies = genes.select("chrom", other.alias("strand"), "gene_id", "start", "end")
    hit = overlaps(extensions.filter("start < end"), bodies, PLACE, width)
    return hit.groupBy("gene_id").agg(F.array_join(F.array_sort(F.collect_set("o_gene_id")), ";").alias("overlaps"))


def bed12(exons: DataFrame) -> DataFrame:
    """A row for each transcript with block sizes and starts; transcripts with overlapping blocks are left out."""
    rows = exons.groupBy("chrom", "strand", "gene_id", "transcript_id").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("b"))
    clear = F.forall(F.sequence(F.lit(1), F.size("b")), lambda i: (i == F.size("b")) | (F.element_at("b", i)["end"] <= F.coalesce(F.try_element_at("b", i + 1)["start"], F.lit(2**62))))
    start = F.col("b")[0]["start"]
    return rows.filter(clear).select(
        "chrom",
        start.alias("start"),
        F.element_at("b", -1)["end"].alias("end"),
        F.concat_ws("|", "gene_id", "transcript_id").alias("name"),
        "strand",
        F.size("b").cast("long").alias("block_count"),
        F.array_join(F.transform("b", lambda x: (x["end"] - x["start"]).cast("string")), ",").alias("block_sizes"),
        F.array_join(F.transform("b", lambda x: (x["start"] - F.col("b")[0]["start"]).cast("string")), ",").alias("block_starts"),
    )


def _touched(reads: DataFrame, union: DataFrame, width: int) -> DataFrame:
    """(sample_id, read, n, gene_id) of reads that touch genes: how many, and the first of them. Exons are few
    against reads, which need not be sorted to meet them."""
    hit = overlaps(reads, union.hint("shuffle_hash"), PLACE, width).select("sample_id", "read", "o_gene_id").distinct()
    return hit.groupBy("sample_id", "read").agg(F.count(F.lit(1)).alias("n"), F.min("o_gene_id").alias("gene_id"))


def unique_gene_counts(reads: DataFrame, union: DataFrame, width: int = BIN) -> DataFrame:
    """As ``read_gene_counts``, of genes alone: reads that touch none are not looked at again."""
    return _touched(reads, union, width).filter("n = 1").groupBy("sample_id", "gene_id").agg(F.count(F.lit(1)).alias("count"))


def read_gene_counts(reads: DataFrame, union: DataFrame, width: int = BIN) -> DataFrame:
    """(sample_id, gene_id, count) of reads (sample_id, read, chrom, strand, start, end blocks): a read
    counts for the only gene it touches; those of several or none go to rows of their own."""
    per = _touched(reads, union, width)
    all_reads = reads.select("sample_id", "read").distinct()
    label = F.when(F.col("n") == 1, F.col("gene_id")).when(F.col("n") > 1, "__ambiguous").otherwise("__no_feature")
    return all_reads.join(per, ["sample_id", "read"], "left").groupBy("sample_id", label.alias("gene_id")).agg(F.count(F.lit(1)).alias("count"))


def strand_coverage(blocks: DataFrame) -> DataFrame:
    return coverage(blocks.select("sample_id", *PLACE, "start", "end"), ["sample_id", *PLACE])


def signal_bedgraph(points: DataFrame, scales: DataFrame, order: DataFrame) -> DataFrame:
    """Scaled one-position intervals, negative on the minus strand, with the contig's ordinal; samples
    without a position have one zero interval over the first contig."""
    sign = F.when(F.col("strand") == "-", -1.0).otherwise(1.0)
    rows = points.join(scales, "sample_id").join(order.select("chrom", "ordinal"), "chrom").select(
        "sample_id", "ordinal", "chrom", "strand", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), (F.col("count") * F.col("scale") * sign).alias("value")
    )
    first = order.orderBy("ordinal").limit(1)
    strands = F.explode(F.array(F.lit("+"), F.lit("-")))
    empty = scales.select("sample_id", strands.alias("strand")).join(rows.select("sample_id", "strand").distinct(), ["sample_id", "strand"], "left_anti")
    zero = empty.join(first.hint("broadcast")).select("sample_id", "ordinal", "chrom", "strand", F.lit(0).cast("long").alias("start"), F.col("size").alias("end"), F.lit(0.0).alias("value"))
    return rows.unionByName(zero)


def track_scales(families: DataFrame, factors: DataFrame) -> DataFrame:
    """(sample_id, family, denominator, raw, cpm, deseq2, robust) of (sample_id, family, total, denominator_of)."""
    totals = families.select("sample_id", F.col("family").alias("denominator_of"), F.col("total").alias("denominator"))
    return families.join(totals, ["sample_id", "denominator_of"]).join(factors, "sample_id", "left").select(
        "sample_id",
        "family",
        "denominator",
        F.lit(1.0).alias("raw"),
        F.when(F.col("denominator") > 0, F.lit(1e6) / F.col("denominator")).alias("cpm"),
        "deseq2_scale",
        "robust_scale",
    )


