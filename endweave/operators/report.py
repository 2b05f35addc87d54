"""Summaries and ranked extracts for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def contrast_summary(results: DataFrame, fdr: float = 0.05) -> DataFrame:
    """Tested and significant results of each contrast, under either way to read the threshold."""
    valid = F.col("pvalue").isNotNull() & F.col("stat").isNotNull()
    sig = F.coalesce(F.col("padj") <= fdr, F.lit(False))
    return results.groupBy("contrast_id").agg(
        F.count(F.lit(1)).alias("rows_seen"),
        F.count_if(valid).alias("valid_tests"),
        F.count_if(sig).alias("significant_le"),
        F.count_if(F.col("padj") < fdr).alias("significant_lt"),
        F.count_if(sig & (F.col("effect") > 0)).alias("up"),
        F.count_if(sig & (F.col("effect") < 0)).alias("down"),
    )


def reconciled(summary: DataFrame, index: DataFrame) -> DataFrame:
    """Counts that an index states (contrast_id, significant) against those found: stale rows are marked."""
    return index.join(summary.select("contrast_id", F.col("significant_le").alias("found")), "contrast_id", "left").withColumn(
        "stale", ~F.col("significant").eqNullSafe(F.col("found"))
    )


def top(df: DataFrame, by: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each group."""
    window = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return df.withColumn("rank", F.row_number().over(window.orderBy(*order))).filter(F.col("rank") <= n)


def first_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows of a table with their rank: each task keeps n, so that none sees all rows."""
    kept = df.orderBy(*order).limit(n)
    return kept.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def contrast_report(expression: DataFrame, genes: DataFrame, sites: DataFrame, premature: DataFrame, matches: DataFrame, methods: list[str], fdr: float = 0.05) -> DataFrame:
    """One row for each contrast of ``expression`` (contrast_id, effect, pvalue, padj): its tests and, for
    each usage method, those of ``genes`` (method, contrast_id, gene_padj, shift), of ``sites`` (method,
    contrast_id, padj) and the candidates of ``premature`` (method, contrast_id); at last the pairs of
    ``matches`` (contrast_id, agree) between two methods. What is missing counts as 0, the share of
    agreement is null without pairs."""
    sig = lambda c: F.coalesce(F.col(c) <= fdr, F.lit(False))
    out = expression.groupBy("contrast_id").agg(
        F.count_if(F.col("padj").isNotNull()).alias("dge_tested_genes"),
        F.count_if(sig("padj")).alias("dge_significant"),
        F.count_if(sig("padj") & (F.col("effect") > 0)).alias("dge_up"),
        F.count_if(sig("padj") & (F.col("effect") < 0)).alias("dge_down"),
    )

    def per(df: DataFrame, counts: dict) -> DataFrame:
        return df.groupBy("contrast_id").agg(*[F.count_if((F.col("method") == m) & c).alias(f"{m}_{name}") for m in methods for name, c in counts.items()])

    hit = sig("gene_padj")
    parts = [
        per(genes, {"tested_genes": F.col("gene_padj").isNotNull(), "significant_genes": hit, "distal_genes": hit & (F.col("shift") == "distal"), "proximal_genes": hit & (F.col("shift") == "proximal")}),
        per(sites, {"tested_sites": F.col("padj").isNotNull(), "significant_sites": sig("padj")}),
        per(premature, {"pcpa": F.lit(True)}),
        matches.groupBy("contrast_id").agg(F.count("agree").alias("compared_sites"), F.count_if("agree").alias("direction_agree"), F.count_if(~F.col("agree")).alias("direction_disagree")),
    ]
    for part in parts:
        out = out.join(part, "contrast_id", "left")
    out = out.fillna(0)
    return out.withColumn("agreement_pct", F.when(F.col("compared_sites") > 0, 100 * F.col("direction_agree") / F.col("compared_sites")))
