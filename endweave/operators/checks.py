"""Strict lookups, contracts of reused inputs, gates on audits, and filters of usage tests."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from endweave.session import cut


def missing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the left table that the right one lacks."""
    return left.select(*keys).distinct().join(right.select(*keys), keys, "left_anti")


def strict_lookup(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join that fails while it runs if a key is missing."""
    found = right.withColumn("found_", F.lit(True))
    joined = left.join(found, keys, "left")
    guard = F.when(F.col("found_"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("missing: "), F.concat_ws("/", *keys))).cast("boolean"))
    return joined.withColumn("found_", guard).filter("found_").drop("found_")


def reused_ends(unclipped: DataFrame, clipped: DataFrame, totals: DataFrame) -> DataFrame:
    """All ends of a sample from both tables (chrom, strand, pos, count), with whether their sum is the
    number of its alignments (sample_id, c0)."""
    both = unclipped.unionByName(clipped).groupBy("sample_id", "chrom", "strand", "pos").agg(F.sum("count").alias("count"))
    sums = both.groupBy("sample_id").agg(F.sum("count").alias("s")).join(totals, "sample_id").select("sample_id", (F.col("s") == F.col("c0")).alias("complete"))
    return both.join(sums, "sample_id")


def alignment_contract(alignments: DataFrame, sizes: DataFrame) -> DataFrame:
    """(sample_id, reads, unfit, unknown_contig, out_of_bounds) of alignments taken over from elsewhere."""
    from endweave.functions.genomics import is_c0

    rows = alignments.join(sizes, "chrom", "left")
    return rows.groupBy("sample_id").agg(
        F.count(F.lit(1)).alias("reads"),
        F.count_if(~is_c0(F.col("flag"), F.col("nh"))).alias("unfit"),
        F.count_if(F.col("size").isNull()).alias("unknown_contig"),
        F.count_if((F.col("ref_start") < 0) | (F.col("ref_end") > F.col("size"))).alias("out_of_bounds"),
    )


def audit_faults(audit: DataFrame) -> DataFrame:
    """(contrast_id, fault) of audits of staged tests whose counts or status contradict each other."""
    n = F.col
    warn = n("screening_na") + n("confirmation_na") + n("excluded_genes") > 0
    faults = F.array_compact(
        F.array(
            F.when(n("screening_na") > n("screening_tests"), "more_missing_than_tests"),
            F.when(n("confirmation_na") > n("confirmation_tests"), "more_missing_than_sites"),
            F.when(n("screening_tests") != n("screening_na") + n("excluded_genes") + n("input_genes"), "genes_do_not_add_up"),
            F.when(n("input_sites") < 2 * n("input_genes"), "too_few_sites"),
            F.when(warn != (n("status") == "WARN_UNTESTABLE_PVALUES"), "status"),
        )
    )
    return audit.select("contrast_id", F.explode(faults).alias("fault"))


def usage_filter(
    counts: DataFrame, expr: int = 5, expr_samples: int = 2, share: float = 0.05, share_samples: int = 2, gene_expr: int = 10, gene_samples: int = 2
) -> DataFrame:
    """Sites (pas_id, gene_id) with enough counts and shares, of genes with enough counts, in enough
    samples each; genes left with one site go."""
    total = F.sum("count").over(Window.partitionBy("gene_id", "sample_id"))
    rows = counts.withColumn("total", total)
    per = rows.groupBy("pas_id", "gene_id").agg(
        F.count_if(F.col("count") >= expr).alias("a"),
        F.count_if((F.col("total") > 0) & (F.col("count") / F.col("total") >= share)).alias("b"),
        F.count_if(F.col("total") >= gene_expr).alias("c"),
    )
    kept = per.filter((F.col("a") >= expr_samples) & (F.col("b") >= share_samples) & (F.col("c") >= gene_samples))
    return kept.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("gene_id"))).filter("n >= 2").select("pas_id", "gene_id")


def confirmed_premature(candidates: DataFrame, tests: DataFrame, catalog: DataFrame, level: float = 0.05, least: float = 0.1) -> DataFrame:
    """Candidates that are significant and change enough, of genes whose terminal site was tested in the
    same contrast (tests: contrast_id, pas_id, padj, delta)."""
    ends = catalog.filter("feature_class = 'terminal_exon'").select("pas_id", "gene_id")
    tested = tests.join(ends, "pas_id").select("contrast_id", "gene_id").distinct()
    hit = tests.filter((F.col("padj") < level) & (F.abs("delta") >= least)).join(candidates.select("pas_id", "gene_id"), "pas_id")
    return hit.join(tested, ["contrast_id", "gene_id"], "left_semi").select("contrast_id", "pas_id", "gene_id")


def mapping_audit(genes: DataFrame, terms: DataFrame) -> DataFrame:
    """How many query genes a database knows (query, database, genes, mapped, foreground_mapped)."""
    known = terms.select("database", "gene_id").distinct()
    n = genes.groupBy("query").agg(F.count(F.lit(1)).alias("genes"))
    hit = genes.join(known, "gene_id").groupBy("query", "database").agg(F.count(F.lit(1)).alias("mapped"), F.sum("foreground").alias("foreground_mapped"))
    return hit.join(n, "query").select("query", "database", "genes", "mapped", "foreground_mapped")


def ordered_tracks(tracks: DataFrame, first: list[str]) -> DataFrame:
    """Tracks by collection: the listed ones in their order, then the others by name, strands counted."""
    at = F.array_position(F.array(*[F.lit(x) for x in first]), F.col("collection")).cast("long")
    per = tracks.groupBy("collection").agg(F.count_if(F.col("strand") == "+").alias("plus"), F.count_if(F.col("strand") == "-").alias("minus"))
    place = F.row_number().over(Window.orderBy(F.when(at > 0, at).otherwise(F.lit(999)), "collection"))
    return per.withColumn("place", place)


def repaired_scores(members: DataFrame) -> DataFrame:
    """Cluster scores as the sums of their members' (cluster_id, score)."""
    return members.groupBy("cluster_id").agg(F.sum("score").cast("long").alias("score"), F.count(F.lit(1)).alias("members"))


def linkage_order(distances: list[tuple[str, str, float]]) -> list[str]:
    """Leaves of a complete-linkage tree of few samples, nearer clusters first."""
    names = sorted({x for a, b, _ in distances for x in (a, b)})
    d = {frozenset((a, b)): v for a, b, v in distances}
    groups = [[n] for n in names]
    while len(groups) > 1:
        far = [(max(d[frozenset((x, y))] for x in a for y in b), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j]
        _, i, j = min(far)
        groups[i] = groups[i] + groups.pop(j)
    return groups[0] if groups else []


def stabilised(counts: DataFrame, factors: DataFrame, base: float, slope: float) -> DataFrame:
    """Variance-stabilised counts for the dispersion trend base + slope / mean, on a log2 scale."""
    q = F.col("count") / F.col("size_factor")
    a = F.lit(float(base))
    inner = 1 + slope + 2 * a * q + 2 * F.sqrt(a * q * (1 + slope + a * q))
    return counts.join(factors.select("sample_id", "size_factor"), "sample_id").select("gene_id", "sample_id", (F.log(inner / (4 * a)) / float(np.log(2))).alias("value"))


#: The ways to fit with the status each asks for, and the library protocol of manifests that name none.
FIT_STATUS = {"standard": "PASS", "deterministic_add_uniform_retry": "WARN_NUMERIC_RETRY"}
SINGLE_END = "quantseq_rev_v2_se"


def fit_faults(audit: DataFrame) -> DataFrame:
    """(contrast_id, fault) of audits of usage fits (status, fit_policy, multifactor, one_way, add_uniform,
    seed, first_error): a plain fit has no retry, a retry needs a design of several factors and a reason."""
    n = F.col
    plain, retry = FIT_STATUS
    retried = n("fit_policy") == retry
    known = retried | (n("fit_policy") == plain)
    reason = F.coalesce(n("first_error"), F.lit("")) != ""
    faults = F.array_compact(
        F.array(
            F.when(~F.coalesce(known, F.lit(False)), "policy"),
            F.when(known & ~n("status").eqNullSafe(F.when(retried, FIT_STATUS[retry]).otherwise(FIT_STATUS[plain])), "status"),
            F.when(F.coalesce(n("seed") <= 0, F.lit(True)), "seed"),
            F.when(n("one_way") == n("multifactor"), "design"),
            F.when(~retried & (n("add_uniform") | reason), "unexpected_retry"),
            F.when(retried & ~(n("multifactor") & n("add_uniform") & reason), "incomplete_retry"),
        )
    )
    return audit.select("contrast_id", F.explode(faults).alias("fault"))


def manifest_faults(manifests: DataFrame, genome: str, protocol: str) -> DataFrame:
    """(manifest, fault) of validation manifests (schema_version, status, engine_commit, adapter_commit,
    model_sha256, environment_sha256, umi_present, deduplicated, library_protocols, assemblies,
    synthetic_pass, reuse_pass, canary, reviewed_by, accepted_at); a null is a fault wherever a value is
    asked for, but manifests without protocols are of single-end libraries."""
    n = F.col
    asked = {
        "not_accepted": (n("schema_version") == 1) & (n("status") == "accepted"),
        "engine_commit": n("engine_commit").rlike("^[0-9a-fA-F]{7,40}$"),
        "adapter_commit": n("adapter_commit").rlike("^[0-9a-fA-F]{7,40}$"),
        "model_sha256": n("model_sha256").rlike("^[0-9a-fA-F]{64}$"),
        "environment_sha256": n("environment_sha256").rlike("^[0-9a-fA-F]{64}$"),
        "deduplication": ~n("umi_present") & ~n("deduplicated"),
        "protocol": F.array_contains(F.coalesce("library_protocols", F.array(F.lit(SINGLE_END))), protocol),
        "assembly": F.array_contains("assemblies", genome),
        "pilot": n("synthetic_pass") & n("reuse_pass"),
        "canary": n("canary") == "PASS",
        "review": (F.trim("reviewed_by") != "") & (F.trim("accepted_at") != ""),
    }
    faults = F.array_compact(F.array(*[F.when(~F.coalesce(fine, F.lit(False)), name) for name, fine in asked.items()]))
    return manifests.select("manifest", F.explode(faults).alias("fault"))


def dispersion_trend(counts: DataFrame, factors: DataFrame, rounds: int = 3) -> tuple[float, float]:
    """(base, slope) of the trend base + slope / mean through genes' dispersions by moments, weighted by the
    inverse square of the trend of the round before, as errors grow with it. Genes without counts or with
    less variance than counting alone gives play no part; without two other genes the trend is (0.1, 0)."""
    q = F.col("count") / F.col("size_factor")
    per = counts.join(F.broadcast(factors.select("sample_id", "size_factor")), "sample_id").groupBy("gene_id").agg(
        F.avg(q).alias("mean"), F.var_samp(q).alias("var"), F.avg(1 / F.col("size_factor")).alias("z")
    )
    genes = per.filter("mean > 0").select((1 / F.col("mean")).alias("x"), ((F.col("var") - F.col("z") * F.col("mean")) / (F.col("mean") * F.col("mean"))).alias("y"))
    genes = cut(genes.filter("y > 1e-8"))
    base, slope = 1.0, 0.0
    for _ in range(rounds):
        height = F.lit(base) + F.lit(slope) * F.col("x")
        w = 1 / (height * height)
        s = genes.agg(*[F.sum(w * v).alias(k) for k, v in {"n": F.lit(1.0), "x": F.col("x"), "y": F.col("y"), "xx": F.col("x") * F.col("x"), "xy": F.col("x") * F.col("y")}.items()]).first()
        spread = s["n"] * s["xx"] - s["x"] * s["x"] if s["n"] else 0.0
        if spread <= 0:
            return (max(s["y"] / s["n"], 1e-8), 0.0) if s["n"] else (0.1, 0.0)
        slope = max((s["n"] * s["xy"] - s["x"] * s["y"]) / spread, 0.0)
        base = max((s["y"] - slope * s["x"]) / s["n"], 1e-8)
    return base, slope
