"""Queries on contracts, gates, filters and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from endweave.operators import checks as K
from endweave.operators import ends as E
from endweave.operators.assign import premature_candidates
from endweave.operators.multitest import staged_audit
from endweave.plans import adapters as T
from endweave.plans.core import PLACE, Study
from endweave.plans.models import _SF, _factors
from endweave.plans.registry import query
from endweave.plans.statistics import _BH, _STAGE, _TERMS, _USE, _foreground, _made_tests, _stage_tables, _terms, r6
from endweave.plans.tables import _cross_sql
from endweave.session import cut


@query(T.sql("""SELECT sample_id, chrom, strand, pos, CAST(unclipped + clipped AS BIGINT) AS count, true AS complete FROM en""", "en"))
def endpoint_reuse(spark, d):
    study = Study(spark, d)
    part = lambda c: study.ends.filter(F.col(c) > 0).select("sample_id", *PLACE, "pos", F.col(c).alias("count"))
    totals = study.ends.groupBy("sample_id").agg(F.sum(F.col("unclipped") + F.col("clipped")).alias("c0"))
    return K.reused_ends(part("unclipped"), part("clipped"), totals)


@query(T.sql("""SELECT sample_id, CAST(count(*) AS BIGINT) AS reads, CAST(count(*) FILTER (WHERE NOT ((flag & 2308) = 0 AND coalesce(nh, 0) = 1)) AS BIGINT) AS unfit,
 CAST(count(*) FILTER (WHERE size IS NULL) AS BIGINT) AS unknown_contig, CAST(count(*) FILTER (WHERE ref_start < 0 OR ref_end > size) AS BIGINT) AS out_of_bounds FROM al LEFT JOIN sz USING (chrom) GROUP BY 1""", "al", "sz"))
def alignment_contract(spark, d):
    return K.alignment_contract(T.alignments(spark, d), T.sizes(spark, d))


@query(T.sql("SELECT pas_id, sample_id, count, gene_id FROM ct JOIN cat USING (pas_id)", "ct", "cat"))
def strict_site_lookup(spark, d):
    study = Study(spark, d)
    return K.strict_lookup(study.counts, study.catalog.select("pas_id", "gene_id"), ["pas_id"]).select("pas_id", "sample_id", "count", "gene_id")


@query(T.sql("""SELECT pas_id, gene_id FROM (SELECT *, count(*) OVER (PARTITION BY gene_id) AS n FROM (SELECT pas_id, gene_id FROM (
 SELECT pas_id, gene_id, count, sum(count) OVER (PARTITION BY gene_id, sample_id) AS t FROM ct JOIN cat USING (pas_id) WHERE assignment_status = 'unique') GROUP BY 1, 2
 HAVING count(*) FILTER (WHERE count >= 2) >= 2 AND count(*) FILTER (WHERE t > 0 AND count / t >= 0.05) >= 2 AND count(*) FILTER (WHERE t >= 4) >= 2)) WHERE n >= 2""", "ct", "cat"))
def usage_filter(spark, d):
    study = Study(spark, d)
    unique = study.catalog.filter("assignment_status = 'unique'").select("pas_id", "gene_id")
    return K.usage_filter(study.counts.join(unique, "pas_id"), expr=2, gene_expr=4)


@query(T.sql("""SELECT 'c0' AS contrast_id, pas_id, gene_id FROM tp WHERE padj < 0.05 AND abs(delta) >= 0.01 AND pas_id IN (
 SELECT pas_id FROM cat WHERE assignment_status = 'unique' AND feature_class IN ('intron', 'other_exon') AND gene_id IN (SELECT gene_id FROM cat WHERE assignment_status = 'unique' AND feature_class = 'terminal_exon'))
 AND gene_id IN (SELECT cat.gene_id FROM tp JOIN cat ON cat.pas_id = tp.pas_id WHERE feature_class = 'terminal_exon')""", "ct", "cat", "smp", **_USE))
def pcpa_confirmed(spark, d):
    study = Study(spark, d)
    tests = _made_tests(study).select(F.lit("c0").alias("contrast_id"), "pas_id", "padj", F.col("delta_pau").alias("delta"))
    return K.confirmed_premature(premature_candidates(study.catalog), tests, study.catalog, 0.05, 0.01)


@query(T.sql("""SELECT query, database, CAST(n AS BIGINT) AS genes, CAST(m AS BIGINT) AS mapped, CAST(f AS BIGINT) AS foreground_mapped FROM (
 SELECT query, database, count(*) AS m, sum(foreground) AS f FROM qg JOIN (SELECT DISTINCT database, gene_id FROM tm) USING (gene_id) GROUP BY 1, 2) JOIN (SELECT query, count(*) AS n FROM qg GROUP BY 1) USING (query)""", "rs", **_BH, **_TERMS))
def mapping_audit(spark, d):
    return K.mapping_audit(_foreground(spark, d), _terms(spark, d))


@query(T.sql("""SELECT collection, CAST(count(*) FILTER (WHERE strand = '+') AS BIGINT) AS plus, CAST(count(*) FILTER (WHERE strand = '-') AS BIGINT) AS minus,
 CAST(row_number() OVER (ORDER BY CASE collection WHEN 'EUROPE' THEN 1 WHEN 'ASIA' THEN 2 ELSE 999 END, collection) AS INTEGER) AS place FROM (
 SELECT r_name AS collection, CASE WHEN n_nationkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM nation JOIN region ON r_regionkey = n_regionkey) GROUP BY 1"""))
def track_collections(spark, d):
    n, r = T.table(spark, d, "nation"), T.table(spark, d, "region")
    tracks = n.join(r, n.n_regionkey == r.r_regionkey).select(F.col("r_name").alias("collection"), F.when(F.col("n_nationkey") % 2 == 0, "+").otherwise("-").alias("strand"))
    return K.ordered_tracks(tracks, ["EUROPE", "ASIA"])


@query("SELECT p_brand AS cluster_id, CAST(sum(p_size) AS BIGINT) AS score, CAST(count(*) AS BIGINT) AS members FROM part GROUP BY 1")
def score_repair(spark, d):
    return K.repaired_scores(T.table(spark, d, "part").select(F.col("p_brand").alias("cluster_id"), F.col("p_size").alias("score")))


@query(T.sql("""SELECT contrast_id, fault FROM (SELECT contrast_id, unnest([CASE WHEN sn > st THEN 'more_missing_than_tests' END, CASE WHEN cn > ct THEN 'more_missing_than_sites' END, CASE WHEN st <> sn + eg + ig THEN 'genes_do_not_add_up' END,
 CASE WHEN si < 2 * ig THEN 'too_few_sites' END, CASE WHEN (sn + cn + eg > 0) <> warned THEN 'status' END]) AS fault FROM a) WHERE fault IS NOT NULL""", "gn", **_STAGE, sa="""SELECT count(*) AS st, count(*) FILTER (WHERE pvalue IS NULL) AS sn,
 count(*) FILTER (WHERE pvalue IS NOT NULL AND coalesce(n, 0) < 2) AS eg, count(*) FILTER (WHERE pvalue IS NOT NULL AND n >= 2) AS ig, coalesce(sum(n) FILTER (WHERE pvalue IS NOT NULL AND n >= 2), 0) AS si
 FROM gp LEFT JOIN (SELECT gene_id, count(*) AS n FROM fp WHERE pvalue IS NOT NULL GROUP BY 1) USING (gene_id)""",
 a="""SELECT 'c' || k AS contrast_id, 100 AS st, k % 120 AS sn, k % 3 AS eg, 100 - k % 120 - k % 3 + CASE WHEN k % 7 = 0 THEN 1 ELSE 0 END AS ig, 50 AS ct, k % 60 AS cn, 150 - k % 90 AS si, k % 2 = 0 AS warned
 FROM (SELECT c_custkey AS k FROM customer) UNION ALL SELECT 'staged', st, sn, eg, ig, ct, cn, si, sn + cn + eg > 0 FROM sa, (SELECT count(*) AS ct, count(*) FILTER (WHERE pvalue IS NULL) AS cn FROM fp)
 UNION ALL SELECT 'staged_stale', st, sn, eg, ig, ct, cn, si, false FROM sa, (SELECT count(*) AS ct, count(*) FILTER (WHERE pvalue IS NULL) AS cn FROM fp)"""))
def audit_gate(spark, d):
    """The audit of the staged tests, once more with a status that is out of date, and audits made of customers,
    most of which contradict themselves somewhere."""
    k = F.col("c_custkey")
    made = T.table(spark, d, "customer").select(
        F.concat(F.lit("c"), k.cast("string")).alias("contrast_id"), F.lit(100).alias("screening_tests"), (k % 120).alias("screening_na"), (k % 3).alias("excluded_genes"),
        (100 - k % 120 - k % 3 + (k % 7 == 0).cast("int")).alias("input_genes"), F.lit(50).alias("confirmation_tests"), (k % 60).alias("confirmation_na"), (150 - k % 90).alias("input_sites"),
        F.when(k % 2 == 0, "WARN_UNTESTABLE_PVALUES").otherwise("PASS").alias("status"),
    )
    staged = cut(staged_audit(*_stage_tables(spark, d)))
    stale = staged.withColumn("status", F.lit("PASS")).withColumn("contrast_id", F.lit("staged_stale"))
    return K.audit_faults(made.unionByName(staged.withColumn("contrast_id", F.lit("staged"))).unionByName(stale))


@query(T.sql("""SELECT gene_id, sample_id, round(ln((1 + 2 + 2 * 0.1 * q + 2 * sqrt(0.1 * q * (1 + 2 + 0.1 * q))) / (4 * 0.1)) / ln(2), 6) AS value FROM (
 SELECT gc.gene_id, gc.sample_id, gc.count / size_factor AS q FROM gc JOIN sf USING (sample_id))""", "ct", "cat", **_SF))
def stabilised_counts(spark, d):
    from endweave.operators.ends import gene_counts

    study = Study(spark, d)
    return K.stabilised(gene_counts(study.catalog, study.counts), _factors(study), 0.1, 2.0).select("gene_id", "sample_id", *r6("value"))


@query(T.sql("SELECT pas_id, CAST(sum(count) AS BIGINT) AS total, CAST(count(*) FILTER (WHERE count > 0) AS BIGINT) AS supporting_samples FROM ct GROUP BY 1 HAVING sum(count) >= 5 AND count(*) FILTER (WHERE count > 0) >= 2", "ct"))
def site_support(spark, d):
    return E.supported(Study(spark, d).counts)


@query(T.sql("""SELECT sample_id, c2, coalesce(c3, 0) AS c3, active_sites, ambiguous_sites, premature_sites, round(100.0 * coalesce(c3, 0) / c2, 2) AS c3_pct FROM (
 SELECT sample_id, CAST(sum(count) AS BIGINT) AS c2 FROM c2 GROUP BY 1) LEFT JOIN (SELECT sample_id, CAST(sum(count) AS BIGINT) AS c3 FROM ct GROUP BY 1) USING (sample_id)
 CROSS JOIN (SELECT CAST(count(*) AS BIGINT) AS active_sites, CAST(count(*) FILTER (WHERE assignment_status = 'ambiguous') AS BIGINT) AS ambiguous_sites,
 CAST(count(*) FILTER (WHERE assignment_status = 'unique' AND feature_class IN ('intron', 'other_exon') AND gene_id IN (SELECT gene_id FROM cat WHERE assignment_status = 'unique' AND feature_class = 'terminal_exon')) AS BIGINT) AS premature_sites FROM cat)""", "c2", "ct", "cat"))
def site_totals(spark, d):
    study = Study(spark, d)
    return E.site_totals(study.c2, study.counts, study.catalog, premature_candidates(study.catalog))


@query(_cross_sql("SELECT match_class, CAST(count(*) AS BIGINT) AS sites FROM mt GROUP BY 1"))
def crosswalk_classes(spark, d):
    from endweave.operators.compare import class_counts
    from endweave.plans.tables import _matches

    return class_counts(_matches(Study(spark, d)))


@query(T.sql("SELECT CAST(row_number() OVER (ORDER BY padj, contrast_id, gene_id) AS INTEGER) AS rank, contrast_id, gene_id, round(effect, 6) AS effect FROM bh WHERE padj IS NOT NULL ORDER BY padj, contrast_id, gene_id LIMIT 100", "rs", **_BH))
def top_events(spark, d):
    from endweave.operators.report import first_rows
    from endweave.plans.statistics import _adjusted

    return first_rows(_adjusted(spark, d).filter("padj is not null"), ["padj", "contrast_id", "gene_id"], 100).select("rank", "contrast_id", "gene_id", *r6("effect"))


@query()
def wald_contrasts(spark, d):
    """Every contrast by its own design, adjusted after independent filtering."""
    from endweave.operators.compare import over_contrasts
    from endweave.operators.models import negative_binomial_tests
    from endweave.operators.multitest import filtered_bh

    study = Study(spark, d)
    samples = T.samples(spark, d).withColumn("ordinal", F.col("condition"))
    # Written once: factors, buckets and fits of every contrast read counts of genes again.
    counts = cut(E.gene_counts(study.catalog, study.counts))
    return filtered_bh(over_contrasts(negative_binomial_tests, counts, samples).drop("padj"), ["contrast_id"])


def _usage_contrasts(spark, d, fit):
    from endweave.operators.compare import over_contrasts
    from endweave.plans.statistics import _testable

    study = Study(spark, d)
    samples = T.samples(spark, d).withColumn("ordinal", F.col("condition"))
    return over_contrasts(fit, study.counts.join(_testable(study).select("pas_id", "gene_id"), "pas_id"), samples)


@query()
def exon_usage_contrasts(spark, d):
    """Every contrast by its own design."""
    from endweave.operators.models import usage_tests

    return _usage_contrasts(spark, d, usage_tests)


@query()
def dm_usage_audit(spark, d):
    """Fits of every contrast, and what the gate holds against their audit."""
    from endweave.operators.models import dirichlet_tests, usage_fit_audit

    tests = _usage_contrasts(spark, d, dirichlet_tests)
    audit = usage_fit_audit(tests, "~ subject + condition")
    faults = K.fit_faults(audit).groupBy("contrast_id").agg(F.sort_array(F.collect_set("fault")).alias("faults"))
    return audit.join(faults, "contrast_id", "left").withColumn("faults", F.concat_ws(",", F.coalesce("faults", F.array().cast("array<string>"))))


@query(T.sql("""SELECT gene_id, 'several_biotypes' AS fault FROM ex GROUP BY 1 HAVING count(DISTINCT kind) > 1 UNION ALL SELECT gene_id, 'several_contigs' FROM ex GROUP BY 1 HAVING count(DISTINCT chrom) > 1
 UNION ALL SELECT gene_id, 'several_strands' FROM ex GROUP BY 1 HAVING count(DISTINCT strand) > 1 UNION ALL SELECT gene_id, 'unknown_contig' FROM ex LEFT JOIN sz USING (chrom) GROUP BY 1 HAVING bool_or(size IS NULL)
 UNION ALL SELECT gene_id, 'out_of_bounds' FROM ex LEFT JOIN sz USING (chrom) GROUP BY 1 HAVING bool_or(start < 0 OR "end" > size OR "end" <= start)""", "ex", "sz"))
def model_faults(spark, d):
    from endweave.sources.readers import model_faults as faults

    ex = T.exons(spark, d).select("gene_id", "chrom", "strand", "start", "end", F.lit("exon").alias("feature"), F.col("kind").alias("biotype"))
    return faults(ex, T.sizes(spark, d))
