"""Size factors, expression filters, diagnostics and within-gene usage."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def size_factors(counts: DataFrame, feature: str = "gene_id") -> DataFrame:
    """(sample_id, total, size_factor, geometric_mean, deseq2_scale, robust_scale) by positive counts:
    each count over its feature's geometric mean, the median of a sample's ratios, all scaled to a
    geometric mean of 1. A feature's mean takes zeros as 0 in the logarithm, over all samples."""
    n = counts.select("sample_id").distinct().count()
    logs = counts.groupBy(feature).agg((F.sum(F.when(F.col("count") > 0, F.log("count")).otherwise(0.0)) / F.lit(n)).alias("mean_log"), F.max("count").alias("most"))
    ratio = F.when(F.col("count") > 0, F.exp(F.log("count") - F.col("mean_log")))
    rows = counts.join(logs.filter("most > 0"), feature).withColumn("ratio", ratio)
    per = rows.groupBy("sample_id").agg(F.percentile("ratio", F.lit(0.5)).alias("median"))
    sums = counts.groupBy("sample_id").agg(F.sum("count").cast("long").alias("total"))
    per = sums.join(per, "sample_id", "left")
    every = Window.partitionBy(F.lit(0))
    per = per.withColumn("size_factor", F.exp(F.log("median") - F.avg(F.log("median")).over(every)))
    per = per.withColumn("geometric_mean", F.exp(F.avg(F.when(F.col("total") > 0, F.log("total"))).over(every)))
    return per.select(
        "sample_id", "total", "size_factor", "geometric_mean",
        (F.lit(1.0) / F.col("size_factor")).alias("deseq2_scale"),
        (F.lit(1e6) / (F.col("size_factor") * F.col("geometric_mean"))).alias("robust_scale"),
    )


def correlations(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pearson's correlation of log2(count + 1) over the features both have, per sample."""
    both = left.withColumnRenamed("count", "a").join(right.withColumnRenamed("count", "b"), ["gene_id", "sample_id"])
    return both.groupBy("sample_id").agg(F.count(F.lit(1)).alias("genes"), F.corr(F.log2(F.col("a") + 1), F.log2(F.col("b") + 1)).alias("pearson"))


def discrepancies(left: DataFrame, right: DataFrame, pseudo: float = 0.5, least: float = 2.0) -> DataFrame:
    """Features whose counts per million differ by ``least`` in log2; totals are those of all features."""
    def cpm(df, name):
        total = df.groupBy("sample_id").agg(F.sum("count").alias("t"))
        return df.join(total, "sample_id").select("gene_id", "sample_id", ((F.col("count") + pseudo) * 1e6 / F.col("t")).alias(name))

    both = cpm(left, "a").join(cpm(right, "b"), ["gene_id", "sample_id"]).withColumn("log2_ratio", F.log2(F.col("a") / F.col("b")))
    return both.filter(F.abs("log2_ratio") >= least).select("gene_id", "sample_id", "log2_ratio")


def leverage_floor(design: np.ndarray) -> float:
    """The smallest group that a design can tell apart: 1 over the largest leverage, slower beyond 10."""
    q, _ = np.linalg.qr(design)
    n = 1.0 / float((q**2).sum(axis=1).max())
    return 10 + (n - 10) * 0.7 if n > 10 else n


def expression_filter(counts: DataFrame, n: float, min_count: int = 10, min_total: int = 15) -> DataFrame:
    """(gene_id, total, samples_above, kept, reason)."""
    libraries = counts.groupBy("sample_id").agg(F.sum("count").alias("library"))
    middle = libraries.agg(F.percentile("library", F.lit(0.5)).alias("middle")).first()["middle"] or 1.0
    cutoff = min_count / middle * 1e6
    rows = counts.join(libraries, "sample_id")
    per = rows.groupBy("gene_id").agg(F.sum("count").cast("long").alias("total"), F.count_if(F.col("count") * 1e6 / F.col("library") >= cutoff).alias("samples_above"))
    few, low = F.col("samples_above") < math.ceil(n - 1e-14), F.col("total") < min_total
    reason = F.when(few & low, "low_cpm_and_total").when(few, "low_cpm").when(low, "low_total").otherwise("kept")
    return per.select("gene_id", "total", "samples_above", (~few & ~low).alias("kept"), reason.alias("reason"))


def testable_sites(counts: DataFrame, catalog: DataFrame, min_count: int = 5) -> DataFrame:
    """Unique sites of genes with two of them, with enough counts, again of genes with two."""
    gene = Window.partitionBy("gene_id")
    total = counts.groupBy("pas_id").agg(F.sum("count").alias("total"))
    unique = catalog.filter("assignment_status = 'unique' and gene_id <> ''").select("pas_id", "gene_id", "strand", "summit")
    first = unique.withColumn("n", F.count(F.lit(1)).over(gene)).filter("n >= 2").drop("n")
    enough = first.join(total, "pas_id").filter(F.col("total") >= min_count)
    return enough.withColumn("n", F.count(F.lit(1)).over(gene)).filter("n >= 2").select("pas_id", "gene_id", "strand", "summit", "total")


def usage(counts: DataFrame, sites: DataFrame) -> DataFrame:
    """(pas_id, gene_id, sample_id, count, pau): shares of a gene's counts, null where it has none."""
    rows = counts.join(sites.select("pas_id", "gene_id"), "pas_id")
    total = F.sum("count").over(Window.partitionBy("gene_id", "sample_id"))
    return rows.select("pas_id", "gene_id", "sample_id", "count", F.when(total > 0, F.col("count") / total).alias("pau"))


def unpaired_effect(pau: DataFrame, samples: DataFrame, denominator: str, numerator: str) -> DataFrame:
    by = lambda c: F.avg(F.when(F.col("condition") == c, F.col("pau")))
    rows = pau.join(samples, "sample_id").groupBy("pas_id", "gene_id").agg(by(denominator).alias("pau_denominator"), by(numerator).alias("pau_numerator"))
    return rows.withColumn("delta_pau", F.col("pau_numerator") - F.col("pau_denominator"))


def pair_deltas(pau: DataFrame, samples: DataFrame, denominator: str, numerator: str) -> DataFrame:
    """(pas_id, gene_id, subject, pau_denominator, pau_numerator, delta_pau) of subjects with one sample of each."""
    one = samples.groupBy("subject").agg(
        F.count_if(F.col("condition") == denominator).alias("d"), F.count_if(F.col("condition") == numerator).alias("n")
    ).filter("d = 1 and n = 1").select("subject")
    rows = pau.join(samples.join(one, "subject"), "sample_id")
    by = lambda c: F.max(F.when(F.col("condition") == c, F.col("pau")))
    pairs = rows.groupBy("pas_id", "gene_id", "subject").agg(by(denominator).alias("pau_denominator"), by(numerator).alias("pau_numerator"))
    return pairs.withColumn("delta_pau", F.col("pau_numerator") - F.col("pau_denominator"))


def paired_effect(pau: DataFrame, samples: DataFrame, denominator: str, numerator: str) -> DataFrame:
    """Means over the pairs that are valid on both sides."""
    both = F.col("delta_pau").isNotNull()
    mean = lambda c: F.avg(F.when(both, F.col(c)))
    pairs = pair_deltas(pau, samples, denominator, numerator)
    return pairs.groupBy("pas_id", "gene_id").agg(
        mean("pau_denominator").alias("pau_denominator"), mean("pau_numerator").alias("pau_numerator"), mean("delta_pau").alias("delta_pau"), F.count_if(both).alias("pairs")
    )


def pooled_usage(means: DataFrame, floor: float | None = None) -> DataFrame:
    """Shares of mean counts (den, num) in their gene: 0 where it has none, or with a floored total."""
    gene = Window.partitionBy("gene_id")

    def share(c):
        total = F.sum(c).over(gene)
        if floor is not None:
            return F.col(c) / F.greatest(total, F.lit(floor))
        return F.when(total > 0, F.col(c) / total).otherwise(0.0)

    return means.withColumn("pau_denominator", share("den")).withColumn("pau_numerator", share("num")).withColumn("delta_pau", F.col("pau_numerator") - F.col("pau_denominator"))


def oriented(strand: str = "strand", pos: str = "summit"):
    return F.when(F.col(strand) == "+", F.col(pos)).otherwise(-F.col(pos))


def weighted_shift(effects: DataFrame) -> DataFrame:
    """(gene_id, shift_nt): effects weighted by the position along the transcript, null without an effect."""
    return effects.groupBy("gene_id").agg(F.sum(F.col("delta_pau") * oriented()).alias("shift_nt"))


def direction(dn, pn, dd, pd):
    """From the two ratios' cross product."""
    none = ((dn == 0) & (pn == 0)) | ((dd == 0) & (pd == 0))
    return F.when(none, "not_classifiable").when(dn * pd > pn * dd, "distal").when(dn * pd < pn * dd, "proximal").otherwise("no_directional_change")


def ratio_text(numerator, denominator):
    return F.when((numerator == 0) & (denominator == 0), "NA").when(denominator == 0, "Inf").otherwise(F.format_string("%.6f", numerator / denominator))


def two_site_shift(tests: DataFrame, fdr: float = 0.05) -> DataFrame:
    """The shift between two sites of each gene (pas_id, gene_id, strand, summit, padj, delta_pau, mean,
    raw, pau_denominator, pau_numerator): the two most significant, or the only significant one and
    the strongest other."""
    sig = F.coalesce(F.col("padj") < fdr, F.lit(False))
    gene = Window.partitionBy("gene_id")
    best = gene.orderBy(sig.desc(), "padj", F.abs("delta_pau").desc(), F.col("mean").desc(), "summit", "pas_id")
    rows = tests.withColumn("sig", sig).withColumn("nsig", F.count_if(sig).over(gene)).withColumn("rank", F.row_number().over(best))
    other = (F.col("rank") > 1) & (F.coalesce("mean", F.lit(0.0)) > 0)
    second = gene.orderBy(other.desc(), F.col("mean").desc(), F.col("raw").desc(), "summit", "pas_id")
    rows = rows.withColumn("other", other).withColumn("orank", F.row_number().over(second))
    chosen = (F.col("nsig") > 0) & ((F.col("rank") == 1) | F.when(F.col("nsig") >= 2, F.col("rank") == 2).otherwise(F.col("other") & (F.col("orank") == 1)))
    site = F.struct(oriented().alias("at"), F.col("pas_id"), F.col("pau_numerator").alias("n"), F.col("pau_denominator").alias("d"))
    per = rows.groupBy("gene_id").agg(F.max("nsig").alias("nsig"), F.sort_array(F.collect_list(F.when(chosen, site))).alias("c"))
    two = F.size("c") == 2
    p, q = F.try_element_at("c", F.lit(1)), F.try_element_at("c", F.lit(2))
    return per.select(
        "gene_id",
        F.when(F.col("nsig") == 0, "no_shift").when(~two, "not_classifiable").otherwise(direction(q["n"], p["n"], q["d"], p["d"])).alias("shift"),
        F.when(two, p["pas_id"]).otherwise("").alias("proximal_pas"),
        F.when(two, q["pas_id"]).otherwise("").alias("distal_pas"),
        F.when(two, ratio_text(q["n"], p["n"])).otherwise("NA").alias("ratio_numerator"),
        F.when(two, ratio_text(q["d"], p["d"])).otherwise("NA").alias("ratio_denominator"),
        F.when(F.col("nsig") == 0, "no_significant_pas").when(~two, "no_nonzero_comparator").when(F.col("nsig") >= 2, "two_significant_lowest_padj").otherwise("one_significant_vs_highest_mean_normalized_other").alias("comparator_rule"),
    )


def gene_summary(tests: DataFrame, fdr: float = 0.05, min_delta: float = 0.1) -> DataFrame:
    """Per gene (… gene_padj, padj, delta_pau): counts of sites, the largest effect, the shift and its score."""
    sig = F.coalesce(F.col("padj") <= fdr, F.lit(False))
    primary = sig & F.coalesce(F.abs("delta_pau") >= min_delta, F.lit(False))
    at = F.struct(oriented().alias("at"), F.col("pas_id"))
    per = tests.groupBy("gene_id").agg(
        F.max("gene_padj").alias("gene_padj"),
        F.count(F.lit(1)).alias("testable_sites"),
        F.count_if(sig).alias("significant_sites"),
        F.count_if(primary).alias("primary_sites"),
        F.max(F.abs("delta_pau")).alias("max_abs_delta_pau"),
        F.sum(F.col("delta_pau") * oriented()).alias("shift_nt"),
        F.min(at)["pas_id"].alias("proximal_pas"),
        F.max(at)["pas_id"].alias("distal_pas"),
    )
    per = per.withColumn("significant_gene", F.coalesce(F.col("gene_padj") <= fdr, F.lit(False)))
    per = per.withColumn("primary_gene", F.col("significant_gene") & (F.col("primary_sites") > 0))
    shift = F.when(~F.col("primary_gene") | F.col("shift_nt").isNull(), "no_shift").when(F.col("shift_nt") > 0, "distal").when(F.col("shift_nt") < 0, "proximal").otherwise("no_directional_change")
    score = -F.log10(F.greatest("gene_padj", F.lit(2.2250738585072014e-308)))
    per = per.withColumn("shift", shift)
    return per.withColumn("signed_shift_score", F.when(F.col("shift") == "distal", score).when(F.col("shift") == "proximal", -score).otherwise(0.0))


def conservation(pau: DataFrame) -> DataFrame:
    """The largest distance from 1 of a gene's summed shares in a sample."""
    sums = pau.filter("pau is not null").groupBy("gene_id", "sample_id").agg(F.sum("pau").alias("s"))
    return sums.groupBy("sample_id").agg(F.max(F.abs(F.col("s") - 1)).alias("worst"), F.count(F.lit(1)).alias("genes"))
