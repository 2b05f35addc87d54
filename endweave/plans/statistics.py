"""Queries on expression, usage, testing and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from endweave.operators import annotation as N
from endweave.operators import enrich as R
from endweave.operators import ends as E
from endweave.operators import expression as X
from endweave.operators import multitest as M
from endweave.plans import adapters as T
from endweave.plans.core import Study
from endweave.plans.models import _SF, _blocks, _UNION
from endweave.plans.registry import query
from endweave.session import written


def r6(*names):
    return [F.round(n, 6).alias(n) for n in names]


def _exonic(spark, d):
    return N.unique_gene_counts(_blocks(spark, d), N.exon_union(T.exons(spark, d)), T.GENE_BIN)


_C5 = {
    "rd": "SELECT * FROM c0",
    "un": _UNION,
    "c5": """SELECT sample_id, g AS gene_id, count(*) AS count FROM (SELECT rid, min(sample_id) AS sample_id, count(DISTINCT gene_id) AS n, min(gene_id) AS g FROM rd JOIN un
 ON un.chrom = rd.chrom AND un.strand = rd.strand AND un.start < rd.ref_end AND rd.ref_start < un."end" GROUP BY 1) WHERE n = 1 GROUP BY ALL""",
    "gc": _SF["gc"],
}


@query(T.sql("SELECT sample_id, CAST(count(*) AS BIGINT) AS genes, round(corr(log2(gc.count + 1), log2(c5.count + 1)), 6) AS pearson FROM gc JOIN c5 USING (gene_id, sample_id) GROUP BY 1", "c0", "ex", "ct", "cat", **_C5))
def c4_c5_correlation(spark, d):
    study = Study(spark, d)
    return X.correlations(E.gene_counts(study.catalog, study.counts), _exonic(spark, d)).select("sample_id", "genes", *r6("pearson"))


@query(T.sql("""SELECT gene_id, sample_id, round(v, 6) AS log2_ratio FROM (SELECT gc.gene_id, gc.sample_id, log2(((gc.count + 0.5) * 1e6 / t4) / ((c5.count + 0.5) * 1e6 / t5)) AS v
 FROM gc JOIN c5 USING (gene_id, sample_id) JOIN (SELECT sample_id, sum(count) AS t4 FROM gc GROUP BY 1) USING (sample_id) JOIN (SELECT sample_id, sum(count) AS t5 FROM c5 GROUP BY 1) USING (sample_id)) WHERE abs(v) >= 2""", "c0", "ex", "ct", "cat", **_C5))
def c4_c5_discrepancies(spark, d):
    study = Study(spark, d)
    return X.discrepancies(E.gene_counts(study.catalog, study.counts), _exonic(spark, d)).select("gene_id", "sample_id", *r6("log2_ratio"))


@query(T.sql("""SELECT gene_id, total, samples_above, samples_above >= 3 AND total >= 15 AS kept, CASE WHEN samples_above < 3 AND total < 15 THEN 'low_cpm_and_total' WHEN samples_above < 3 THEN 'low_cpm'
 WHEN total < 15 THEN 'low_total' ELSE 'kept' END AS reason FROM (SELECT gene_id, CAST(sum(count) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE count * 1e6 / library >= 10 / mid * 1e6) AS BIGINT) AS samples_above
 FROM gc JOIN lb USING (sample_id), (SELECT median(library) AS mid FROM lb) GROUP BY 1)""", "ct", "cat", gc=_SF["gc"], lb="SELECT sample_id, sum(count) AS library FROM gc GROUP BY 1"))
def expression_filter_audit(spark, d):
    import numpy as np

    study = Study(spark, d)
    design = np.array([[1.0, float(i >= 3)] for i in range(6)])
    return X.expression_filter(E.gene_counts(study.catalog, study.counts), X.leverage_floor(design))


_USE = {
    "t1": "SELECT * FROM (SELECT cat.pas_id, cat.gene_id, cat.strand, cat.summit, count(*) OVER (PARTITION BY gene_id) AS n FROM cat WHERE assignment_status = 'unique') WHERE n >= 2",
    "t2": "SELECT * EXCLUDE (n) FROM t1 JOIN (SELECT pas_id, CAST(sum(count) AS BIGINT) AS total FROM ct GROUP BY 1) USING (pas_id) WHERE total >= 5",
    "ts": "SELECT * EXCLUDE (n) FROM (SELECT *, count(*) OVER (PARTITION BY gene_id) AS n FROM t2) WHERE n >= 2",
    "pu": """SELECT pas_id, gene_id, sample_id, count, CASE WHEN sum(count) OVER w > 0 THEN count / sum(count) OVER w END AS pau FROM ct JOIN ts USING (pas_id) WINDOW w AS (PARTITION BY gene_id, sample_id)""",
    "un": """SELECT pas_id, gene_id, avg(pau) FILTER (WHERE condition = 'A') AS d, avg(pau) FILTER (WHERE condition = 'B') AS n FROM pu JOIN smp USING (sample_id) GROUP BY 1, 2""",
    "pd": """SELECT pas_id, gene_id, subject, max(pau) FILTER (WHERE condition = 'A') AS d, max(pau) FILTER (WHERE condition = 'B') AS n FROM pu JOIN smp USING (sample_id) GROUP BY 1, 2, 3""",
    "mn": """SELECT pas_id, gene_id, strand, summit, avg(count) FILTER (WHERE condition = 'A') AS d, avg(count) FILTER (WHERE condition = 'B') AS n, avg(count) AS mean, sum(count) AS raw
 FROM ct JOIN ts USING (pas_id) JOIN smp USING (sample_id) GROUP BY 1, 2, 3, 4""",
    "po": """SELECT *, CASE WHEN sum(d) OVER (PARTITION BY gene_id) > 0 THEN d / sum(d) OVER (PARTITION BY gene_id) ELSE 0 END AS pau_d, CASE WHEN sum(n) OVER (PARTITION BY gene_id) > 0 THEN n / sum(n) OVER (PARTITION BY gene_id) ELSE 0 END AS pau_n FROM mn""",
    "tt": """SELECT po.*, pau_n - pau_d AS delta, pow((CAST(substr(pas_id, 5) AS BIGINT) * 7919) % 1009 + 1, 2) / 4080400.0 AS pvalue FROM po""",
    "tp": """SELECT *, CASE WHEN pvalue <= 0.05 THEN pvalue END AS padj, min(pvalue) OVER (PARTITION BY gene_id) AS gene_padj FROM tt""",
}


def _testable(study: Study):
    return X.testable_sites(study.counts, study.catalog)


def _pau(study: Study):
    return X.usage(study.counts, _testable(study))


def _means(study: Study):
    rows = study.counts.join(_testable(study).select("pas_id", "gene_id", "strand", "summit"), "pas_id").join(T.samples(study.spark, study.d), "sample_id")
    by = lambda c: F.avg(F.when(F.col("condition") == c, F.col("count")))
    return rows.groupBy("pas_id", "gene_id", "strand", "summit").agg(by("A").alias("den"), by("B").alias("num"), F.avg("count").alias("mean"), F.sum("count").alias("raw"))


def _made_tests(study: Study):
    """Sites with made-up p-values: those of at most 0.05 count as adjusted ones."""
    pooled = X.pooled_usage(_means(study))
    p = F.pow(F.pmod(F.substring("pas_id", F.lit(5), F.lit(8)).cast("long") * 7919, F.lit(1009)) + 1, F.lit(2)) / F.lit(4080400.0)
    rows = pooled.withColumn("pvalue", p)
    from pyspark.sql import Window

    return rows.withColumn("padj", F.when(F.col("pvalue") <= 0.05, F.col("pvalue"))).withColumn("gene_padj", F.min("pvalue").over(Window.partitionBy("gene_id")))


@query(T.sql("SELECT pas_id, gene_id, total FROM ts", "ct", "cat", **_USE))
def testable_sites(spark, d):
    return _testable(Study(spark, d)).select("pas_id", "gene_id", "total")


@query(T.sql("SELECT pas_id, gene_id, sample_id, round(pau, 6) AS pau FROM pu", "ct", "cat", **_USE))
def pau_raw(spark, d):
    return _pau(Study(spark, d)).select("pas_id", "gene_id", "sample_id", *r6("pau"))


@query(T.sql("SELECT pas_id, gene_id, round(d, 6) AS pau_denominator, round(n, 6) AS pau_numerator, round(n - d, 6) AS delta_pau FROM un", "ct", "cat", "smp", **_USE))
def pau_unpaired_effect(spark, d):
    return X.unpaired_effect(_pau(Study(spark, d)), T.samples(spark, d), "A", "B").select("pas_id", "gene_id", *r6("pau_denominator", "pau_numerator", "delta_pau"))


@query(T.sql("SELECT pas_id, gene_id, subject, round(d, 6) AS pau_denominator, round(n, 6) AS pau_numerator, round(n - d, 6) AS delta_pau FROM pd", "ct", "cat", "smp", **_USE))
def pau_pair_deltas(spark, d):
    return X.pair_deltas(_pau(Study(spark, d)), T.samples(spark, d), "A", "B").select("pas_id", "gene_id", "subject", *r6("pau_denominator", "pau_numerator", "delta_pau"))


@query(T.sql("""SELECT pas_id, gene_id, round(avg(d) FILTER (WHERE n - d IS NOT NULL), 6) AS pau_denominator, round(avg(n) FILTER (WHERE n - d IS NOT NULL), 6) AS pau_numerator, round(avg(n - d), 6) AS delta_pau,
 CAST(count(n - d) AS BIGINT) AS pairs FROM pd GROUP BY 1, 2""", "ct", "cat", "smp", **_USE))
def pau_paired_effect(spark, d):
    return X.paired_effect(_pau(Study(spark, d)), T.samples(spark, d), "A", "B").select("pas_id", "gene_id", *r6("pau_denominator", "pau_numerator", "delta_pau"), "pairs")


@query(T.sql("SELECT pas_id, gene_id, round(pau_d, 6) AS pau_denominator, round(pau_n, 6) AS pau_numerator, round(pau_n - pau_d, 6) AS delta_pau FROM po", "ct", "cat", "smp", **_USE))
def pau_normalised_effect(spark, d):
    return X.pooled_usage(_means(Study(spark, d))).select("pas_id", "gene_id", *r6("pau_denominator", "pau_numerator", "delta_pau"))


@query(T.sql("""SELECT pas_id, gene_id, round(d / greatest(sum(d) OVER w, 1e-12), 6) AS pau_denominator, round(n / greatest(sum(n) OVER w, 1e-12), 6) AS pau_numerator FROM (
 SELECT pas_id, gene_id, avg(count) FILTER (WHERE condition = 'A') AS d, avg(count) FILTER (WHERE condition = 'B') AS n FROM ct JOIN cat USING (pas_id) JOIN smp USING (sample_id) GROUP BY 1, 2) WINDOW w AS (PARTITION BY gene_id)""", "ct", "cat", "smp"))
def pau_pooled_effect(spark, d):
    study = Study(spark, d)
    rows = study.counts.join(study.catalog.select("pas_id", "gene_id"), "pas_id").join(T.samples(spark, d), "sample_id")
    by = lambda c: F.avg(F.when(F.col("condition") == c, F.col("count")))
    means = rows.groupBy("pas_id", "gene_id").agg(by("A").alias("den"), by("B").alias("num"))
    return X.pooled_usage(means, 1e-12).select("pas_id", "gene_id", *r6("pau_denominator", "pau_numerator"))


@query(T.sql("SELECT gene_id, round(sum((pau_n - pau_d) * CASE WHEN strand = '+' THEN summit ELSE -summit END), 4) AS shift_nt FROM po GROUP BY 1", "ct", "cat", "smp", **_USE))
def weighted_shift(spark, d):
    return X.weighted_shift(X.pooled_usage(_means(Study(spark, d)))).select("gene_id", F.round("shift_nt", 4).alias("shift_nt"))


_DIR = "CASE WHEN (qn = 0 AND pn = 0) OR (qd = 0 AND pd = 0) THEN 'not_classifiable' WHEN qn * pd > pn * qd THEN 'distal' WHEN qn * pd < pn * qd THEN 'proximal' ELSE 'no_directional_change' END"
_SHIFT = {
    "s1": "SELECT *, count(padj) OVER (PARTITION BY gene_id) AS nsig, row_number() OVER (PARTITION BY gene_id ORDER BY padj IS NULL, padj, abs(delta) DESC, mean DESC, summit, pas_id) AS rk FROM tp",
    "s2": "SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY (rk > 1 AND mean > 0) DESC, mean DESC, raw DESC, summit, pas_id) AS ork FROM s1",
    "s3": "SELECT * FROM s2 WHERE nsig > 0 AND (rk = 1 OR CASE WHEN nsig >= 2 THEN rk = 2 ELSE ork = 1 AND rk > 1 AND mean > 0 END)",
    "s4": """SELECT gene_id, count(*) AS c, arg_min(pas_id, loc) AS p, arg_max(pas_id, loc) AS q, arg_min(pau_n, loc) AS pn, arg_max(pau_n, loc) AS qn, arg_min(pau_d, loc) AS pd, arg_max(pau_d, loc) AS qd
 FROM (SELECT *, CASE WHEN strand = '+' THEN summit ELSE -summit END AS loc FROM s3) GROUP BY 1""",
    "sh": f"""SELECT gene_id, nsig, c, CASE WHEN nsig = 0 THEN 'no_shift' WHEN c <> 2 THEN 'not_classifiable' ELSE {_DIR} END AS shift, CASE WHEN c = 2 THEN p ELSE '' END AS proximal_pas, CASE WHEN c = 2 THEN q ELSE '' END AS distal_pas,
 CASE WHEN nsig = 0 THEN 'no_significant_pas' WHEN c <> 2 THEN 'no_nonzero_comparator' WHEN nsig >= 2 THEN 'two_significant_lowest_padj' ELSE 'one_significant_vs_highest_mean_normalized_other' END AS comparator_rule
 FROM (SELECT gene_id, max(nsig) AS nsig FROM s1 GROUP BY 1) LEFT JOIN s4 USING (gene_id)""",
}


@query(T.sql("SELECT gene_id, shift, proximal_pas, distal_pas, comparator_rule FROM sh", "ct", "cat", "smp", **_USE, **_SHIFT))
def two_site_shift(spark, d):
    return X.two_site_shift(_made_tests(Study(spark, d))).select("gene_id", "shift", "proximal_pas", "distal_pas", "comparator_rule")


_GS = {
    "gs0": """SELECT gene_id, max(gene_padj) AS gene_padj, count(*) AS testable_sites, count(*) FILTER (WHERE padj <= 0.05) AS significant_sites, count(*) FILTER (WHERE padj <= 0.05 AND abs(delta) >= 0.1) AS primary_sites,
 max(abs(delta)) AS m, sum(delta * loc) AS s, arg_min(pas_id, loc) AS proximal_pas, arg_max(pas_id, loc) AS distal_pas FROM (SELECT *, CASE WHEN strand = '+' THEN summit ELSE -summit END AS loc FROM tp) GROUP BY 1""",
    "gs": """SELECT *, CASE WHEN NOT (gene_padj <= 0.05 AND primary_sites > 0) THEN 'no_shift' WHEN s > 0 THEN 'distal' WHEN s < 0 THEN 'proximal' ELSE 'no_directional_change' END AS shift FROM gs0""",
}


@query(T.sql("""SELECT gene_id, round(gene_padj, 6) AS gene_padj, CAST(testable_sites AS BIGINT) AS testable_sites, CAST(significant_sites AS BIGINT) AS significant_sites, CAST(primary_sites AS BIGINT) AS primary_sites,
 round(m, 6) AS max_abs_delta_pau, shift, proximal_pas, distal_pas, round(CASE shift WHEN 'distal' THEN -log10(gene_padj) WHEN 'proximal' THEN log10(gene_padj) ELSE 0.0 END, 6) AS signed_shift_score FROM gs""", "ct", "cat", "smp", **_USE, **_GS))
def gene_apa_summary(spark, d):
    s = X.gene_summary(_made_tests(Study(spark, d)))
    return s.select("gene_id", *r6("gene_padj"), "testable_sites", "significant_sites", "primary_sites", *r6("max_abs_delta_pau"), "shift", "proximal_pas", "distal_pas", *r6("signed_shift_score"))


@query(T.sql("SELECT sample_id, round(max(abs(s - 1)), 9) AS worst, CAST(count(*) AS BIGINT) AS genes FROM (SELECT gene_id, sample_id, sum(pau) AS s FROM pu WHERE pau IS NOT NULL GROUP BY 1, 2) GROUP BY 1", "ct", "cat", **_USE))
def pau_conservation_audit(spark, d):
    return X.conservation(_pau(Study(spark, d))).select("sample_id", F.round("worst", 9).alias("worst"), "genes")


_BH = {
    "bh0": "SELECT *, pvalue * count(*) OVER (PARTITION BY contrast_id) / count(*) OVER (PARTITION BY contrast_id ORDER BY pvalue) AS sc FROM rs WHERE pvalue IS NOT NULL",
    "bh": "SELECT contrast_id, gene_id, effect, stat, pvalue, least(1.0, min(sc) OVER (PARTITION BY contrast_id ORDER BY pvalue DESC)) AS padj FROM bh0 UNION ALL SELECT contrast_id, gene_id, effect, stat, pvalue, NULL FROM rs WHERE pvalue IS NULL",
}


def _adjusted(spark, d):
    return M.adjust_bh(T.results(spark, d), ["contrast_id"])


@query(T.sql("SELECT contrast_id, gene_id, round(padj, 6) AS padj FROM bh", "rs", **_BH))
def bh_adjust(spark, d):
    return _adjusted(spark, d).select("contrast_id", "gene_id", *r6("padj"))


@query(T.sql("""SELECT contrast_id, CAST(count(*) AS BIGINT) AS rows_seen, CAST(count(*) FILTER (WHERE pvalue IS NOT NULL AND stat IS NOT NULL) AS BIGINT) AS valid_tests,
 CAST(count(*) FILTER (WHERE padj <= 0.05) AS BIGINT) AS significant_le, CAST(count(*) FILTER (WHERE padj < 0.05) AS BIGINT) AS significant_lt,
 CAST(count(*) FILTER (WHERE padj <= 0.05 AND effect > 0) AS BIGINT) AS up, CAST(count(*) FILTER (WHERE padj <= 0.05 AND effect < 0) AS BIGINT) AS down FROM bh GROUP BY 1""", "rs", **_BH))
def contrast_summary(spark, d):
    from endweave.operators.report import contrast_summary as summary

    return summary(_adjusted(spark, d))


_STAGE = {
    "gp": "SELECT gene_id, CASE WHEN g % 11 <> 0 THEN pow((g * 7919) % 1009 + 1, 2) / 4080400.0 END AS pvalue FROM (SELECT gene_id, CAST(substr(gene_id, 2) AS BIGINT) AS g FROM gn)",
    "fp": """SELECT gene_id || '_' || i AS feature_id, gene_id, CASE WHEN (g + i) % 7 <> 0 THEN pow((g * 3571 + i * 233) % 1009 + 1, 2) / 1018081.0 END AS pvalue
 FROM (SELECT gene_id, CAST(substr(gene_id, 2) AS BIGINT) AS g FROM gn), range(4) t(i) WHERE i <= g % 4""",
    "fn": "SELECT fp.*, gp.pvalue AS screen, count(*) OVER (PARTITION BY fp.gene_id) AS n FROM fp JOIN gp USING (gene_id) WHERE fp.pvalue IS NOT NULL AND gp.pvalue IS NOT NULL",
    "fe": "SELECT * FROM fn WHERE n >= 2",
    "sg": "SELECT gene_id, screen, least(1.0, min(sc) OVER (ORDER BY screen DESC)) AS gene_padj FROM (SELECT *, screen * count(*) OVER () / count(*) OVER (ORDER BY screen) AS sc FROM (SELECT DISTINCT gene_id, screen FROM fe))",
    "ff": "SELECT count(*) / count(*) FILTER (WHERE gene_padj <= 0.05) AS f FROM sg",
    "fw": """SELECT *, max(pvalue * greatest(1, CASE WHEN i <= 2 THEN n - 2 ELSE n - i + 1 END)) OVER (PARTITION BY gene_id ORDER BY pvalue, feature_id ROWS UNBOUNDED PRECEDING) AS w
 FROM (SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY pvalue, feature_id) AS i FROM fe)""",
}


def _stage_tables(spark, d):
    g = T.genes(spark, d).select("gene_id", F.substring("gene_id", F.lit(2), F.lit(20)).cast("long").alias("g"))
    genes = g.select("gene_id", F.when(F.col("g") % 11 != 0, F.pow(F.col("g") * 7919 % 1009 + 1, F.lit(2)) / F.lit(4080400.0)).alias("pvalue"))
    f = g.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("g") % 4)))
    p = F.when((F.col("g") + F.col("i")) % 7 != 0, F.pow((F.col("g") * 3571 + F.col("i") * 233) % 1009 + 1, F.lit(2)) / F.lit(1018081.0))
    return genes, f.select(F.concat_ws("_", "gene_id", F.col("i").cast("string")).alias("feature_id"), "gene_id", p.alias("pvalue"))


@query(T.sql("""SELECT fp.feature_id, fp.gene_id, round(CASE WHEN fw.gene_id IS NULL THEN NULL WHEN gene_padj <= 0.05 THEN least(1.0, greatest(gene_padj, w * f)) ELSE 1.0 END, 6) AS stage_adjusted
 FROM fp LEFT JOIN fw USING (feature_id) LEFT JOIN sg ON sg.gene_id = fp.gene_id, ff""", "gn", **_STAGE))
def stagewise_adjust(spark, d):
    return M.staged(*_stage_tables(spark, d)).select("feature_id", "gene_id", *r6("stage_adjusted"))


@query(T.sql("""SELECT *, CASE WHEN screening_na + confirmation_na + excluded_genes > 0 THEN 'WARN_UNTESTABLE_PVALUES' ELSE 'PASS' END AS status FROM (
 SELECT CAST(count(*) AS BIGINT) AS screening_tests, CAST(count(*) FILTER (WHERE pvalue IS NULL) AS BIGINT) AS screening_na, CAST(count(*) FILTER (WHERE pvalue IS NOT NULL AND coalesce(n, 0) < 2) AS BIGINT) AS excluded_genes,
 CAST(count(*) FILTER (WHERE pvalue IS NOT NULL AND n >= 2) AS BIGINT) AS input_genes, CAST(coalesce(sum(n) FILTER (WHERE pvalue IS NOT NULL AND n >= 2), 0) AS BIGINT) AS input_sites
 FROM gp LEFT JOIN (SELECT gene_id, count(*) AS n FROM fp WHERE pvalue IS NOT NULL GROUP BY 1) USING (gene_id)),
 (SELECT CAST(count(*) AS BIGINT) AS confirmation_tests, CAST(count(*) FILTER (WHERE pvalue IS NULL) AS BIGINT) AS confirmation_na FROM fp)""", "gn", **_STAGE))
def stagewise_audit(spark, d):
    return M.staged_audit(*_stage_tables(spark, d))


@query(T.sql("""SELECT gene_id, min_p, CAST(tests AS BIGINT) AS tests, round(least(1.0, min(e / k) OVER (ORDER BY min_p DESC)), 6) AS gene_qvalue FROM (
 SELECT g.*, (SELECT sum(c * (1 - pow(1 - least(g.min_p, 1.0), h.tests))) FROM (SELECT tests, count(*) AS c FROM gq GROUP BY 1) h) AS e, count(*) OVER (ORDER BY min_p) AS k FROM gq g)""",
 "gn", **_STAGE, gq="SELECT gene_id, min(pvalue) AS min_p, count(pvalue) AS tests FROM fp WHERE pvalue IS NOT NULL GROUP BY 1"))
def gene_q_values(spark, d):
    return M.gene_q_values(_stage_tables(spark, d)[1], []).select("gene_id", "min_p", "tests", *r6("gene_qvalue"))


@query(T.sql("""SELECT contrast_id, gene_id, 1 AS background, CAST(sel AS INTEGER) AS foreground, CASE WHEN sel THEN CASE WHEN effect > 0 THEN 'any_dge;upregulated' ELSE 'any_dge;downregulated' END ELSE '' END AS direction,
 round(coalesce(stat, sign(effect) * -log10(greatest(pvalue, 1e-300)), effect, 0.0), 6) AS rank_score FROM (SELECT *, coalesce(padj <= 0.05 AND abs(effect) >= 1, false) AS sel FROM bh)""", "rs", **_BH))
def prepared_gene_table(spark, d):
    p = R.prepared_expression(_adjusted(spark, d), 0.05, 1.0)
    return p.select("contrast_id", "gene_id", "background", "foreground", "direction", *r6("rank_score"))


@query(T.sql("""SELECT contrast_id, gene_id, 1 AS background, CAST(padj <= 0.05 AS INTEGER) AS foreground, CASE WHEN padj <= 0.05 THEN CASE WHEN effect > 0 THEN 'any_dge;upregulated' ELSE 'any_dge;downregulated' END ELSE '' END AS direction,
 round(stat, 6) AS rank_score FROM bh WHERE effect IS NOT NULL AND stat IS NOT NULL AND padj IS NOT NULL""", "rs", **_BH))
def prepared_extended_table(spark, d):
    return R.prepared_extended(_adjusted(spark, d)).select("contrast_id", "gene_id", "background", "foreground", "direction", *r6("rank_score"))


_PC = {"pc": "SELECT gene_id, arg_min(delta, struct_pack(a := -round(abs(delta), 9), o := pas_id)) AS delta FROM tp WHERE padj IS NOT NULL GROUP BY 1"}


def _premature(study: Study):
    return R.strongest(_made_tests(study).filter("padj is not null").select("gene_id", F.col("delta_pau").alias("delta"), F.col("pas_id").alias("ordinal")).withColumn("delta", F.col("delta")))


@query(T.sql("""SELECT pas_id, gene_id, round(delta, 6) AS delta_pau FROM tp WHERE padj <= 0.05 AND abs(delta) >= 0.1 AND pas_id IN (
 SELECT pas_id FROM cat WHERE assignment_status = 'unique' AND feature_class IN ('intron', 'other_exon')
 AND gene_id IN (SELECT gene_id FROM cat WHERE assignment_status = 'unique' AND feature_class = 'terminal_exon'))""", "ct", "cat", "smp", **_USE))
def pcpa_differential(spark, d):
    from endweave.operators.assign import premature_candidates

    study = Study(spark, d)
    tests = _made_tests(study).filter((F.col("padj") <= 0.05) & (F.abs("delta_pau") >= 0.1))
    return tests.join(premature_candidates(study.catalog).select("pas_id"), "pas_id", "left_semi").select("pas_id", "gene_id", *r6("delta_pau"))


@query(T.sql("SELECT gene_id, round(abs(delta), 6) AS strength FROM pc", "ct", "cat", "smp", **_USE, **_PC))
def pcpa_strongest(spark, d):
    return _premature(Study(spark, d)).select("gene_id", F.round(F.abs("delta"), 6).alias("strength"))


@query(T.sql("""SELECT gene_id, CAST(direction <> '' AS INTEGER) AS foreground, direction FROM (SELECT gene_id, concat_ws(';', CASE WHEN prim THEN 'any_apa' END,
 CASE WHEN prim AND shift IN ('distal', 'proximal') THEN shift || '_shift' END, CASE WHEN has THEN 'any_pcpa' END) AS direction
 FROM (SELECT gs.*, gene_padj <= 0.05 AND primary_sites > 0 AS prim, pc.gene_id IS NOT NULL AS has FROM gs LEFT JOIN pc ON pc.gene_id = gs.gene_id))""", "ct", "cat", "smp", **_USE, **_GS, **_PC))
def prepared_usage_table(spark, d):
    study = Study(spark, d)
    p = R.prepared_usage(X.gene_summary(_made_tests(study)), _premature(study))
    return p.select("gene_id", "foreground", F.regexp_replace("direction", ";pcpa_(in|de)creased$", "").alias("direction"))


_TERMS = {
    "ng": "SELECT greatest(count(*) // 20, 1) AS n FROM orders",
    "tm": """SELECT DISTINCT 'brand' AS database, p_brand AS term_id, 'g' || (p_partkey % n) AS gene_id FROM part, ng UNION ALL SELECT DISTINCT 'type', p_type, 'g' || ((p_partkey * 7) % n) FROM part, ng""",
    "qg": "SELECT DISTINCT contrast_id AS query, gene_id, CAST(coalesce(padj <= 0.05, false) AS INTEGER) AS foreground FROM bh",
    "qn": "SELECT query, count(*) AS nn, CAST(sum(foreground) AS BIGINT) AS n FROM qg GROUP BY 1",
    "hh": "SELECT query, database, term_id, count(*) AS m, CAST(sum(foreground) AS BIGINT) AS k FROM qg JOIN tm USING (gene_id) GROUP BY ALL HAVING count(*) BETWEEN 3 AND 500 AND sum(foreground) > 0",
    "lf": "SELECT i, coalesce(sum(ln(i)) OVER (ORDER BY i), 0) AS v FROM (SELECT i FROM range(1, (SELECT max(nn) FROM qn) + 1) t(i)) UNION ALL SELECT 0, 0",
    "la": "SELECT list(v ORDER BY i) AS l FROM lf",
    "hp": """SELECT query, database, term_id, k, m, n, nn, least(1.0, list_sum(list_transform(range(CAST(k AS BIGINT), CAST(least(m, n) AS BIGINT) + 1), lambda x:
 CASE WHEN n - x <= nn - m THEN exp(l[m + 1] - l[x + 1] - l[m - x + 1] + l[nn - m + 1] - l[n - x + 1] - l[nn - m - n + x + 1] - l[nn + 1] + l[n + 1] + l[nn - n + 1]) ELSE 0 END))) AS pvalue FROM hh JOIN qn USING (query), la""",
    "ho": "SELECT *, least(1.0, min(sc) OVER (PARTITION BY query, database ORDER BY pvalue DESC)) AS padj FROM (SELECT *, pvalue * count(*) OVER (PARTITION BY query, database) / count(*) OVER (PARTITION BY query, database ORDER BY round(pvalue, 12)) AS sc FROM hp)",
}


def _terms(spark, d):
    part = T.table(spark, d, "part")
    n = max(T.table(spark, d, "orders").count() // 20, 1)  # a gene has 20 order keys
    gene = lambda c: F.concat(F.lit("g"), (c % n).cast("string"))
    a = part.select(F.lit("brand").alias("database"), F.col("p_brand").alias("term_id"), gene(F.col("p_partkey")).alias("gene_id")).distinct()
    return a.union(part.select(F.lit("type"), F.col("p_type"), gene(F.col("p_partkey") * 7)).distinct())


def _foreground(spark, d):
    a = _adjusted(spark, d)
    return a.select(F.col("contrast_id").alias("query"), "gene_id", F.coalesce(F.col("padj") <= 0.05, F.lit(False)).cast("int").alias("foreground"))


@query(T.sql("SELECT query, database, term_id, CAST(k AS BIGINT) AS k, CAST(m AS BIGINT) AS m, round(pvalue, 6) AS pvalue FROM hp", "rs", **_BH, **_TERMS))
def ora(spark, d):
    return R.ora(_foreground(spark, d), _terms(spark, d)).select("query", "database", "term_id", "k", "m", *r6("pvalue"))


_RANK = {
    "rk": "SELECT query, gene_id, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, gene_id) AS rank FROM (SELECT contrast_id AS query, gene_id, stat AS score FROM rs WHERE stat IS NOT NULL)",
    "gh": """SELECT *, count(*) OVER t AS size, sum(abs(score)) OVER t AS tot, sum(abs(score)) OVER o AS sofar, count(*) OVER o AS i FROM rk JOIN tm USING (gene_id) JOIN (SELECT query, count(*) AS nn FROM rk GROUP BY 1) USING (query)
 WINDOW t AS (PARTITION BY query, database, term_id), o AS (PARTITION BY query, database, term_id ORDER BY rank ROWS UNBOUNDED PRECEDING)""",
    "es": """SELECT query, database, term_id, size, max(sofar / tot - (rank - i) / (nn - size)) AS hi, min((sofar - abs(score)) / tot - (rank - i) / (nn - size)) AS lo FROM gh WHERE size >= 3 AND tot > 0 AND nn > size GROUP BY ALL""",
}


def _ranked(spark, d):
    return R.ranking(T.results(spark, d).select(F.col("contrast_id").alias("query"), "gene_id", F.col("stat").alias("score")))


@query(T.sql("SELECT query, gene_id, round(score, 6) AS score, CAST(rank AS BIGINT) AS rank FROM rk", "rs", **{"ng": _TERMS["ng"], "tm": _TERMS["tm"]} | _RANK))
def gsea_rank(spark, d):
    return _ranked(spark, d).select("query", "gene_id", *r6("score"), F.col("rank").cast("long").alias("rank"))


@query(T.sql("SELECT query, database, term_id, CAST(size AS BIGINT) AS size, round(CASE WHEN hi >= -lo THEN hi ELSE lo END, 6) AS es FROM es", "rs", ng=_TERMS["ng"], tm=_TERMS["tm"], **_RANK))
def gsea_es(spark, d):
    return R.enrichment_scores(_ranked(spark, d), _terms(spark, d)).select("query", "database", "term_id", "size", *r6("es"))


@query(T.sql("""SELECT query, database, term_id, CAST(max(size) AS BIGINT) AS size,
 string_agg(gene_id, ';' ORDER BY CASE WHEN hi >= -lo THEN rank ELSE -rank END) FILTER (CASE WHEN hi >= -lo THEN rank <= peak ELSE rank >= trough END) AS leading_edge FROM (
 SELECT *, max(a) OVER w AS hi, min(b) OVER w AS lo, first_value(rank) OVER (w ORDER BY round(a, 12) DESC, rank) AS peak, first_value(rank) OVER (w ORDER BY round(b, 12), rank DESC) AS trough FROM (
 SELECT *, sofar / al - (rank - i) / (nn - size) AS a, (sofar - abs(score)) / al - (rank - i) / (nn - size) AS b FROM (
 SELECT rk.*, tm.database, tm.term_id, nn, count(*) OVER v AS size, sum(abs(score)) OVER v AS al, sum(abs(score)) OVER (v ORDER BY rank) AS sofar, row_number() OVER (v ORDER BY rank) AS i
 FROM rk JOIN (SELECT DISTINCT * FROM tm) tm USING (gene_id) JOIN (SELECT query, count(*) AS nn FROM rk GROUP BY 1) USING (query) WINDOW v AS (PARTITION BY rk.query, tm.database, tm.term_id))
 WHERE size >= 3 AND al > 0 AND nn > size) WINDOW w AS (PARTITION BY query, database, term_id)) GROUP BY 1, 2, 3""", "rs", **{"ng": _TERMS["ng"], "tm": _TERMS["tm"]} | _RANK))
def gsea_leading_edge(spark, d):
    return R.leading_edges(_ranked(spark, d), _terms(spark, d))


@query()
def gsea_multilevel(spark, d):
    ranked = written(_ranked(spark, d))
    return R.multilevel(R.enrichment_scores(ranked, _terms(spark, d)), ranked)


@query()
def gsea_permuted(spark, d):
    ranked = _ranked(spark, d)
    return R.permuted(R.enrichment_scores(ranked, _terms(spark, d)), ranked)


@query(T.sql("""SELECT e.query, e.database, e.term_id, e.gene_id FROM ed e JOIN (SELECT query, gene_id FROM (SELECT query, gene_id, row_number() OVER (PARTITION BY query ORDER BY count(*) DESC, gene_id) AS r FROM ed GROUP BY 1, 2) WHERE r <= 50) USING (query, gene_id)""",
 "rs", **_BH, **_TERMS, ed="""SELECT t.query, t.database, t.term_id, tm.gene_id FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY k DESC, m, database, term_id) AS r FROM hh) WHERE r <= 8) t
 JOIN tm USING (database, term_id) JOIN qg ON qg.query = t.query AND qg.gene_id = tm.gene_id AND foreground = 1"""))
def concept_network_edges(spark, d):
    genes, terms = _foreground(spark, d), _terms(spark, d)
    # Ranked by hits, then size: whole numbers, so that the order is the same in any engine.
    results = R.ora(genes, terms).withColumn("padj", -F.col("k")).withColumn("pvalue", F.col("m"))
    return R.concept_edges(results, terms, genes)
