"""Multiple testing: adjusted p-values by group, and two stages."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T



def adjust_bh(df: DataFrame, by: list[str], p: str = "pvalue", out: str = "padj", fine: int = 4096, expected: str | None = None) -> DataFrame:
    """Benjamini-Hochberg over the p-values of each group; null and NaN stay null, a null key is a key.

    ``expected`` names a column for the number of tests that chance puts at or below a row's p-value, a
    function of it and the group; p times the number of tests without.

    Equal p-values are one row with a count, however many there are. These are ranked in buckets, ``fine``
    to a factor of two, each with the number of tests below it and the least scaled value above."""
    valid = F.col(p).isNotNull() & ~F.isnan(p)
    keyed = df.withColumn("group_", F.struct(F.lit(0).alias("k"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(by)]))
    tests = keyed.filter(valid).groupBy("group_", F.col(p).alias("p_")).agg(
        F.count(F.lit(1)).alias("n_"), (F.first(expected) if expected else F.lit(None).cast("double")).alias("expected_")
    )
    bucket = F.coalesce(F.floor(F.log2("p_") * fine), F.lit(-(1 << 40)))
    tests = tests.withColumn("bucket_", F.struct("group_", bucket.alias("b"))).repartition("bucket_")
    sizes = tests.groupBy("bucket_").agg(F.sum("n_").alias("n_"))
    every = Window.partitionBy("bucket_.group_")
    below = F.sum("n_").over(every.orderBy("bucket_.b").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("bucket_", F.coalesce(below, F.lit(0)).alias("below_"), F.sum("n_").over(every).alias("all_"))
    order = Window.partitionBy("bucket_").orderBy("p_")
    rank = F.col("below_") + F.sum("n_").over(order.rowsBetween(Window.unboundedPreceding, 0))
    scaled = tests.join(sizes, "bucket_").withColumn("scaled_", F.coalesce("expected_", F.col("p_") * F.col("all_")) / rank)
    # From the largest p-value down as a running minimum, in the bucket and over those above.
    down = Window.partitionBy("bucket_").orderBy(F.col("p_").desc()).rowsBetween(Window.unboundedPreceding, 0)
    above = every.orderBy(F.col("bucket_.b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    least = scaled.groupBy("bucket_").agg(F.min("scaled_").alias("low_")).select("bucket_", F.min("low_").over(above).alias("least_"))
    done = scaled.join(least, "bucket_").select("group_", "p_", F.least(F.lit(1.0), F.min("scaled_").over(down), F.col("least_")).alias(out))
    at = F.when(valid, F.col(p))
    return keyed.withColumn("p_", at).join(done, ["group_", "p_"], "left").select(*df.columns, out)


def gene_q_values(tests: DataFrame, by: list[str], gene: str = "gene_id", p: str = "pvalue", out: str = "gene_qvalue") -> DataFrame:
    """(by, gene, min_p, tests, out) of the genes with a finite p-value: the rate of false genes among those
    whose smallest p-value is at most as large.

    Chance alone brings a gene of n tests below t with probability 1 - (1 - t)^n; its sum over the
    histogram of n, over the genes found below t, made monotone from above."""
    finite = F.col(p).isNotNull() & ~F.isnan(p)
    genes = tests.filter(finite).groupBy(*by, gene).agg(F.min(p).alias("min_p"), F.count(F.lit(1)).alias("tests"))
    keys = F.struct(F.lit(0).alias("k"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(by)])
    # A row for each group and number of tests, of which there are few.
    per = genes.groupBy(keys.alias("of_"), "tests").agg(F.count(F.lit(1)).alias("genes"))
    per = per.groupBy("of_").agg(F.sort_array(F.collect_list(F.struct("tests", "genes"))).alias("hist_"))
    both = genes.withColumn("of_", keys).join(per, "of_")
    chance = lambda h: h["genes"] * -F.expm1(h["tests"] * F.log1p(-F.least(F.col("min_p"), F.lit(1 - 1e-16))))
    both = both.withColumn("chance_", F.aggregate("hist_", F.lit(0.0), lambda held, h: held + chance(h)))
    return adjust_bh(both, by, "min_p", out, expected="chance_").select(*by, gene, "min_p", "tests", out)


def filtered_bh(results: DataFrame, by: list[str], mean: str = "base_mean", p: str = "pvalue", alpha: float = 0.1, steps: int = 50) -> DataFrame:
    """Adds padj after independent filtering: of the quantiles of the mean as cut-offs the first whose
    number of rejections, smoothed, comes within the scatter of the largest; genes below it get null.

    A group's genes are one pandas group: as many as an annotation has."""
    names = results.columns

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        means, ps = pdf[mean].to_numpy(dtype=float), pdf[p].to_numpy(dtype=float)
        lowest = float((means == 0).mean())
        shares = np.linspace(lowest, max(0.95, lowest), steps)
        cutoffs = np.quantile(means, shares)
        counts = np.array([(stepped_up(np.where(means >= c, ps, np.nan)) < alpha).sum() for c in cutoffs], dtype=float)
        chosen = 0
        if counts.max() > 10:
            smooth = local_lines(shares, counts, 0.2)
            held = counts > 0
            enough = smooth.max() - np.sqrt(np.mean((counts[held] - smooth[held]) ** 2))
            chosen = int(np.argmax(counts > enough)) if (counts > enough).any() else 0
        return pdf.assign(padj=stepped_up(np.where(means >= cutoffs[chosen], ps, np.nan)))[[*names, "padj"]]

    schema = T.StructType([*results.schema.fields, T.StructField("padj", T.DoubleType())])
    return results.groupBy(*by).applyInPandas(run, schema)


def stepped_up(p: np.ndarray) -> np.ndarray:
    """Benjamini-Hochberg of an array; NaN stays."""
    out, at = np.full(len(p), np.nan), np.flatnonzero(np.isfinite(p))
    order = at[np.argsort(-p[at], kind="stable")]
    n = len(order)
    out[order] = np.minimum(1.0, np.minimum.accumulate(p[order] * n / np.arange(n, 0, -1)))
    return out


def local_lines(x: np.ndarray, y: np.ndarray, share: float, rounds: int = 3) -> np.ndarray:
    """Locally weighted straight lines through the nearest ``share`` of points, robust against outliers."""
    n = len(x)
    k = min(max(int(share * n + 1e-9), 2), n)
    robust, fit = np.ones(n), y.astype(float)
    for _ in range(rounds + 1):
        for i in range(n):
            far = np.abs(x - x[i])
            reach = np.partition(far, k - 1)[k - 1]
            w = robust * (np.clip(1 - (far / reach) ** 3, 0, None) ** 3 if reach > 0 else (far == 0))
            if w.sum() <= 0:
                continue
            mx, my = np.average(x, weights=w), np.average(y, weights=w)
            spread = np.sum(w * (x - mx) ** 2)
            slope = np.sum(w * (x - mx) * (y - my)) / spread if spread > 1e-12 else 0.0
            fit[i] = my + slope * (x[i] - mx)
        left = np.abs(y - fit)
        scale = 6 * np.median(left)
        if scale <= 0:
            break
        robust = np.clip(1 - (left / scale) ** 2, 0, None) ** 2
    return fit


def staged(genes: DataFrame, features: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Adds ``stage_adjusted`` to features (feature_id, gene_id, pvalue): screening of genes, then
    confirmation inside those that pass, where any two of n hypotheses are true together.

    Only genes with a finite p-value and two finite features take part. Screening is
    Benjamini-Hochberg; inside a gene the i-th smallest p-value counts n - i + 1 times (n - 2 for the
    first two, 1 at least), and values rise; the stage's level is the screening's share of passing
    genes, so that adjusted values are multiplied by genes over passing genes and are never below
    the gene's own; features of genes that do not pass are 1.
    """
    finite = F.col("pvalue").isNotNull() & ~F.isnan("pvalue")
    tested = features.filter(finite).join(genes.filter(finite).select("gene_id", F.col("pvalue").alias("screen")), "gene_id")
    gene = Window.partitionBy("gene_id")
    tested = tested.withColumn("n", F.count(F.lit(1)).over(gene)).filter("n >= 2")
    screened = adjust_bh(tested.select("gene_id", "screen").distinct(), [], "screen", "gene_padj")
    passing = screened.agg(F.count(F.lit(1)).alias("g"), F.count_if(F.col("gene_padj") <= alpha).alias("passed")).first()
    factor = (passing["g"] / passing["passed"]) if passing and passing["passed"] else 1.0
    order = gene.orderBy("pvalue", "feature_id")
    i = F.row_number().over(order)
    times = F.greatest(F.lit(1), F.when(i <= 2, F.col("n") - 2).otherwise(F.col("n") - i + 1))
    inner = tested.join(screened.select("gene_id", "gene_padj"), "gene_id").withColumn("within", F.col("pvalue") * times)
    inner = inner.withColumn("within", F.max("within").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    value = F.when(F.col("gene_padj") <= alpha, F.least(F.lit(1.0), F.greatest("gene_padj", F.col("within") * F.lit(factor)))).otherwise(1.0)
    return features.join(inner.select("feature_id", value.alias("stage_adjusted")), "feature_id", "left")


def staged_audit(genes: DataFrame, features: DataFrame) -> DataFrame:
    """What two-stage testing leaves out, and why."""
    finite = F.col("pvalue").isNotNull() & ~F.isnan("pvalue")
    per = features.filter(finite).groupBy("gene_id").agg(F.count(F.lit(1)).alias("n"))
    g = genes.join(per, "gene_id", "left").agg(
        F.count(F.lit(1)).alias("screening_tests"),
        F.count_if(~finite).alias("screening_na"),
        F.count_if(finite & (F.coalesce("n", F.lit(0)) < 2)).alias("excluded_genes"),
        F.count_if(finite & (F.col("n") >= 2)).alias("input_genes"),
        F.sum(F.when(finite & (F.col("n") >= 2), F.col("n")).otherwise(0)).alias("input_sites"),
    )
    f = features.agg(F.count(F.lit(1)).alias("confirmation_tests"), F.count_if(~finite).alias("confirmation_na"))
    warn = F.col("screening_na") + F.col("confirmation_na") + F.col("excluded_genes") > 0
    return g.join(f.hint("broadcast")).withColumn("status", F.when(warn, "WARN_UNTESTABLE_PVALUES").otherwise("PASS"))
