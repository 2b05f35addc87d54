"""Genes of sites: models, assignment, feature classes, premature-site candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from endweave.operators.intervals import BIN, points_in


def terminal_exons(exons: DataFrame) -> DataFrame:
    """The 3' exon of every transcript: the largest end on the plus strand, the smallest start on the minus."""
    key = F.when(F.col("strand") == "+", F.col("end")).otherwise(-F.col("start"))
    last = F.max_by(F.struct("start", "end"), F.struct(key, -F.abs(key)))
    return exons.groupBy("gene_id", "transcript_id", "chrom", "strand").agg(last.alias("e")).select(
        "gene_id", "transcript_id", "chrom", "strand", "e.start", "e.end"
    )


def extended(genes: DataFrame, extension: int) -> DataFrame:
    """Genes with ``lo`` and ``hi``: the body and an extension at the 3' end."""
    minus = F.col("strand") == "-"
    return genes.withColumn("lo", F.when(minus, F.greatest(F.lit(0), F.col("start") - extension)).otherwise(F.col("start"))).withColumn(
        "hi", F.when(minus, F.col("end")).otherwise(F.col("end") + extension)
    )


def _inside(hits: DataFrame, spans: DataFrame) -> DataFrame:
    """(pas_id, gene_id) of hits whose summit is in one of the gene's intervals."""
    at = hits.select("pas_id", "gene_id", "summit").alias("h")
    s = spans.select("gene_id", "start", "end").alias("s")
    on = (F.col("h.gene_id") == F.col("s.gene_id")) & (F.col("summit") >= F.col("s.start")) & (F.col("summit") < F.col("s.end"))
    return at.join(s, on, "left_semi").select("pas_id", "gene_id")


def gene_hits(sites: DataFrame, genes: DataFrame, exons: DataFrame, extension: int, width: int = BIN) -> DataFrame:
    """(pas_id, gene_id, feature) of all genes of a site's strand whose extended body holds its summit."""
    spans = extended(genes, extension).select("chrom", "strand", "gene_id", F.col("start").alias("gs"), F.col("end").alias("ge"), "lo", "hi")
    hits = points_in(sites.select("pas_id", "chrom", "strand", "summit"), spans, ["chrom", "strand"], "summit", "lo", "hi", width=width)
    terminal = _inside(hits, terminal_exons(exons)).withColumn("terminal", F.lit(True))
    exonic = _inside(hits, exons).withColumn("exonic", F.lit(True))
    return (
        hits.join(terminal, ["pas_id", "gene_id"], "left")
        .join(exonic, ["pas_id", "gene_id"], "left")
        .select(
            "pas_id",
            "gene_id",
            F.when(F.col("terminal"), "terminal_exon")
            .when(F.col("exonic"), "other_exon")
            .when((F.col("summit") >= F.col("gs")) & (F.col("summit") < F.col("ge")), "intron")
            .otherwise("downstream_extension")
            .alias("feature"),
        )
    )


def assign_genes(sites: DataFrame, genes: DataFrame, exons: DataFrame, extension: int, width: int = BIN) -> DataFrame:
    """Sites with gene_id, feature_class and assignment_status: one gene, several, or none."""
    per = gene_hits(sites, genes, exons, extension, width).groupBy("pas_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("feature").alias("feature"), F.array_join(F.array_sort(F.collect_set("gene_id")), ";").alias("ids")
    )
    other = F.when(F.col("strand") == "+", "-").otherwise("+")
    bodies = genes.select("chrom", other.alias("strand"), F.col("start").alias("lo"), F.col("end").alias("hi"))
    anti = points_in(sites.select("pas_id", "chrom", "strand", "summit"), bodies, ["chrom", "strand"], "summit", "lo", "hi", "left_semi", width)
    anti = anti.select("pas_id").withColumn("anti", F.lit(True))
    return (
        sites.join(per, "pas_id", "left")
        .join(anti, "pas_id", "left")
        .select(
            *sites.columns,
            F.coalesce("ids", F.lit("")).alias("gene_id"),
            F.when(F.col("n") == 1, F.col("feature")).when(F.col("n") > 1, "ambiguous").when(F.col("anti"), "antisense").otherwise("intergenic").alias("feature_class"),
            F.when(F.col("n") == 1, "unique").when(F.col("n") > 1, "ambiguous_multi_gene").otherwise("unassigned").alias("assignment_status"),
        )
    )


def annotate_sites(sites: DataFrame, genes: DataFrame, exons: DataFrame, cds: DataFrame, utr: DataFrame, width: int = BIN) -> DataFrame:
    """Strict body hits with UTR, CDS, exon and intron classes; several genes leave the id empty."""
    spans = genes.select("chrom", "strand", "gene_id", F.col("start").alias("gs"), F.col("end").alias("ge"))
    hits = points_in(sites.select("pas_id", "chrom", "strand", "summit"), spans, ["chrom", "strand"], "summit", "gs", "ge", width=width)
    edges = genes.select("gene_id", F.col("start").alias("gs"), F.col("end").alias("ge"), F.col("strand").alias("gst"))
    outer = exons.join(edges, "gene_id").filter(F.when(F.col("gst") == "+", F.col("end") == F.col("ge")).otherwise(F.col("start") == F.col("gs")))
    coding = cds.groupBy("gene_id").agg(F.max("end").alias("cds_end"), F.min("start").alias("cds_start"))
    flags = hits
    for name, spans_ in (("in_utr", utr), ("in_cds", cds), ("in_exon", exons), ("in_terminal", outer)):
        flags = flags.join(_inside(hits, spans_).withColumn(name, F.lit(True)), ["pas_id", "gene_id"], "left")
    flags = flags.join(coding, "gene_id", "left")
    three = F.when(F.col("strand") == "+", F.col("summit") >= F.col("cds_end")).otherwise(F.col("summit") < F.col("cds_start"))
    three = F.when(F.col("cds_end").isNotNull(), three).otherwise(F.coalesce("in_terminal", F.lit(False)))
    feature = (
        F.when(F.col("in_utr"), F.when(three, "terminal_3UTR").otherwise("internal_UTR"))
        .when(F.col("in_cds"), "internal_exon_CDS")
        .when(F.col("in_exon"), F.when(F.col("in_terminal"), "terminal_exon").otherwise("internal_exon"))
        .otherwise("intron")
    )
    per = flags.groupBy("pas_id").agg(F.count(F.lit(1)).alias("n"), F.min(feature).alias("feature"), F.min("gene_id").alias("gene"))
    return sites.join(per, "pas_id", "left").select(
        *sites.columns,
        F.when(F.col("n") == 1, F.col("gene")).otherwise("").alias("gene_id"),
        F.when(F.col("n") == 1, F.col("feature")).when(F.col("n") > 1, "ambiguous_multi_gene").otherwise("intergenic").alias("feature_class"),
    )


def premature_candidates(catalog: DataFrame) -> DataFrame:
    """Unique sites in introns or other exons of genes that have a site in a terminal exon too."""
    unique = catalog.filter("assignment_status = 'unique'")
    ends = unique.filter("feature_class = 'terminal_exon'").select("gene_id")
    return unique.filter(F.col("feature_class").isin("intron", "other_exon")).join(ends, "gene_id", "left_semi")


def upstream_candidates(catalog: DataFrame, genes: DataFrame) -> DataFrame:
    """Candidates strictly upstream of their gene's 3' end, with the consequence their place suggests."""
    edges = genes.select("gene_id", F.col("start").alias("gs"), F.col("end").alias("ge"))
    up = F.when(F.col("strand") == "+", F.col("summit") < F.col("ge") - 1).otherwise(F.col("summit") > F.col("gs"))
    classes = ["intron", "internal_exon", "internal_exon_CDS", "internal_UTR"]
    kind = F.when(F.col("feature_class") == "intron", "composite_or_skipped_terminal_exon").when(F.col("feature_class") == "internal_exon_CDS", "truncated_coding_sequence").otherwise("truncated_transcript")
    return catalog.filter(F.col("feature_class").isin(*classes)).join(edges, "gene_id").filter(up).withColumn("consequence", kind).drop("gs", "ge")
