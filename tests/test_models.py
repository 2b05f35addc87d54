"""Annotation, usage, testing, enrichment, atlases, designs and models on small cases."""

import math
import random

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from endweave.functions.special import chi_square_tail, log_gamma, normal_tail
from endweave.operators import annotation, atlas, compare, design, enrich, expression, models, multitest, qc


def test_barrier_clip(spark):
    genes = spark.createDataFrame([("A", "c", "+", 100, 1000), ("B", "c", "+", 1201, 1500), ("C", "c", "-", 8000, 9000)], "gene_id string, chrom string, strand string, start long, end long")
    exons = genes.withColumn("transcript_id", F.col("gene_id"))
    sizes = spark.createDataFrame([("c", 10000)], "chrom string, size long")
    starts = genes.select("gene_id", "chrom", "strand", F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("end") - 1).alias("tss"))
    wanted = annotation.requested(genes, exons, sizes, 6000)
    got = {r.gene_id: (r.start, r.end, r.reason, r.limiting_gene) for r in annotation.clip(wanted, annotation.barriers(genes, starts, sizes, 1)).collect()}
    assert got["A"] == (1000, 1201, "other_gene_body", "B")
    assert got["B"] == (1500, 7500, "full_cap", "")
    assert got["C"] == (2000, 8000, "full_cap", "")
    got = {r.gene_id: (r.start, r.end, r.reason) for r in annotation.clip(wanted, annotation.barriers(genes, starts, sizes, 101)).collect()}
    assert got["A"] == (1000, 1101, "tss_buffer")


def test_read_counting(spark):
    union = spark.createDataFrame([("A", "c", "+", 0, 100), ("A", "c", "+", 200, 300), ("B", "c", "+", 290, 400), ("C", "c", "-", 0, 50)], "gene_id string, chrom string, strand string, start long, end long")
    reads = [("1", "+", 10, 20), ("2", "+", 90, 95), ("2", "+", 200, 210), ("3", "+", 350, 360), ("4", "-", 10, 20), ("5", "+", 280, 295), ("6", "+", 500, 510)]
    df = spark.createDataFrame([("s", r, "c", st, a, b) for r, st, a, b in reads], "sample_id string, read string, chrom string, strand string, start long, end long")
    got = {r.gene_id: r["count"] for r in annotation.read_gene_counts(df, union).collect()}
    assert got == {"A": 2, "B": 1, "C": 1, "__ambiguous": 1, "__no_feature": 1}


def test_reads_of_one_gene(spark):
    """Counts of genes alone are those of all reads without the two rows for others, and reads are scanned once."""
    from endweave.plans import statistics

    union = spark.createDataFrame([("A", "c", "+", 0, 100), ("A", "c", "+", 200, 300), ("B", "c", "+", 290, 400), (None, "c", "-", 0, 50)], "gene_id string, chrom string, strand string, start long, end long")
    reads = [("1", "+", 10, 20), ("2", "+", 90, 95), ("2", "+", 200, 210), ("3", "+", 350, 360), ("4", "-", 10, 20), ("5", "+", 280, 295), ("6", "+", 500, 510), (None, "+", 10, 20)]
    df = spark.createDataFrame([(s, r, "c", st, a, b) for s in ("s", "t") for r, st, a, b in reads], "sample_id string, read string, chrom string, strand string, start long, end long")
    got = {(r.sample_id, r.gene_id, r["count"]) for r in annotation.unique_gene_counts(df, union, 64).collect()}
    assert got == {(s, g, n) for s in "st" for g, n in (("A", 3), ("B", 1), (None, 1))}
    plan = statistics._exonic(spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("lineitem.parquet") == 1


def test_buckets_are_fitted_by_tasks_of_their_own(spark, monkeypatch):
    """However few rows they have: buckets are spread over partitions that adaptive execution leaves alone."""
    from endweave.operators import models

    monkeypatch.setattr(models, "BUCKET", 10)
    counts = spark.range(80).selectExpr("concat('g', id) as gene_id", "'s' as sample_id", "id as count")
    rows = models.cut(models._buckets(counts))
    fitted = models._by_bucket(rows).applyInPandas(lambda pdf: pdf[["bucket"]].head(1), "bucket long").select("bucket", F.spark_partition_id().alias("task"))
    assert fitted.select("task").distinct().count() > 3


def test_bed12(spark):
    ex = spark.createDataFrame([("g", "t", "c", "+", 100, 150), ("g", "t", "c", "+", 200, 250), ("g", "u", "c", "+", 0, 20), ("g", "u", "c", "+", 10, 30)], "gene_id string, transcript_id string, chrom string, strand string, start long, end long")
    rows = annotation.bed12(ex).collect()
    assert [(r.start, r.end, r.block_sizes, r.block_starts) for r in rows] == [(100, 250, "50,50", "0,100")]


def test_usage_effects(spark):
    counts = [("p1", "a1", 75), ("p1", "a2", 7500), ("p1", "a3", 0), ("p1", "b1", 50), ("p1", "b2", 5000), ("p1", "b3", 0), ("p2", "a1", 25), ("p2", "a2", 2500), ("p2", "a3", 0), ("p2", "b1", 50), ("p2", "b2", 5000), ("p2", "b3", 0)]
    df = spark.createDataFrame(counts, "pas_id string, sample_id string, count long")
    sites = spark.createDataFrame([("p1", "g"), ("p2", "g")], "pas_id string, gene_id string")
    samples = spark.createDataFrame([(c + str(i), c.upper(), f"u{i}") for c in "ab" for i in (1, 2, 3)], "sample_id string, condition string, subject string")
    pau = expression.usage(df, sites)
    assert pau.filter("pau is null").count() == 4
    for f in (expression.unpaired_effect, expression.paired_effect):
        assert {r.pas_id: r.delta_pau for r in f(pau, samples, "A", "B").collect()} == {"p1": -0.25, "p2": 0.25}


def test_direction(spark):
    cases = [(2.0, 1.0, 1.0, 2.0, "distal"), (1.0, 2.0, 2.0, 1.0, "proximal"), (1.0, 1.0, 1.0, 1.0, "no_directional_change"), (0.0, 0.0, 1.0, 1.0, "not_classifiable")]
    df = spark.createDataFrame(cases, "a double, b double, c double, d double, want string")
    assert df.filter(expression.direction(F.col("a"), F.col("b"), F.col("c"), F.col("d")) != F.col("want")).count() == 0
    texts = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0)], "n double, d double").select(expression.ratio_text(F.col("n"), F.col("d")).alias("t")).collect()
    assert [r.t for r in texts] == ["NA", "Inf"]


def test_bh(spark):
    p = [0.01, 0.04, 0.03, 0.005, 0.5, None]
    df = spark.createDataFrame([("g", i, x) for i, x in enumerate(p)], "q string, i int, pvalue double")
    got = {r.i: r.padj for r in multitest.adjust_bh(df, ["q"]).collect()}
    assert got[5] is None
    want = {0: 0.025, 1: 0.05, 2: 0.05, 3: 0.025, 4: 0.5}
    assert all(abs(got[i] - w) < 1e-12 for i, w in want.items())


def test_staged_policy(spark):
    genes = spark.createDataFrame([("a", 0.001), ("b", 0.2), ("c", None), ("d", 0.01)], "gene_id string, pvalue double")
    feats = spark.createDataFrame([("a1", "a", 0.001), ("a2", "a", 0.2), ("b1", "b", 0.3), ("b2", "b", 0.4), ("c1", "c", 0.1), ("c2", "c", 0.1), ("d1", "d", 0.02), ("d2", "d", None)], "feature_id string, gene_id string, pvalue double")
    audit = multitest.staged_audit(genes, feats).head()
    assert (audit.screening_na, audit.confirmation_na, audit.excluded_genes, audit.input_genes, audit.input_sites) == (1, 1, 1, 2, 4)
    got = {r.feature_id: r.stage_adjusted for r in multitest.staged(genes, feats).collect()}
    assert got["c1"] is None and got["d1"] is None and got["b1"] == 1.0 and got["a1"] <= 0.05


def test_prepared(spark):
    rows = [("g1", 2.0, 5.0, 0.001, 0.01), ("g2", -3.0, -4.0, 0.002, 0.02), ("g3", 0.3, 0.1, 0.4, 0.5)]
    df = spark.createDataFrame(rows, "gene_id string, effect double, stat double, pvalue double, padj double")
    got = {r.gene_id: (r.foreground, r.direction) for r in enrich.prepared_expression(df, 0.05, 1.0).collect()}
    assert got == {"g1": (1, "any_dge;upregulated"), "g2": (1, "any_dge;downregulated"), "g3": (0, "")}
    summary = spark.createDataFrame([("g1", 0.01, 0.3, True, "distal", 2.0, 1.0), ("g2", 0.5, 0.0, False, "no_shift", 0.0, 0.0)], "gene_id string, gene_padj double, max_abs_delta_pau double, primary_gene boolean, shift string, signed_shift_score double, shift_nt double")
    early = spark.createDataFrame([("g2", -0.4)], "gene_id string, delta double")
    got = {r.gene_id: r.direction for r in enrich.prepared_usage(summary, early).collect()}
    assert got == {"g1": "any_apa;distal_shift", "g2": "any_pcpa;pcpa_decreased"}


def test_prepared_extended_keeps_contrasts(spark):
    rows = [("c0", "g1", 2.0, 5.0, 0.01), ("c1", "g1", -2.0, -5.0, 0.01), ("c2", "g1", 2.0, 5.0, 0.5), ("c2", "g2", None, 5.0, 0.5)]
    df = spark.createDataFrame(rows, "contrast_id string, gene_id string, effect double, stat double, padj double")
    got = {(r.contrast_id, r.gene_id): (r.foreground, r.direction) for r in enrich.prepared_extended(df).collect()}
    assert got == {("c0", "g1"): (1, "any_dge;upregulated"), ("c1", "g1"): (1, "any_dge;downregulated"), ("c2", "g1"): (0, "")}


def test_ora_against_combinatorics(spark):
    genes = spark.createDataFrame([("q", f"g{i}", int(i < 12)) for i in range(50)], "query string, gene_id string, foreground int")
    terms = spark.createDataFrame([("d", "t", f"g{i}") for i in range(5, 20)], "database string, term_id string, gene_id string")
    r = enrich.ora(genes, terms).head()
    want = sum(math.comb(15, k) * math.comb(35, 12 - k) for k in range(7, 13)) / math.comb(50, 12)
    assert (r.k, r.m) == (7, 15) and abs(r.pvalue - want) < 1e-12


def test_running_sum(spark):
    random.seed(2)
    score = {f"g{i}": random.gauss(0, 1) for i in range(120)}
    member = random.sample(sorted(score), 12)
    ranked = enrich.ranking(spark.createDataFrame([("q", g, s) for g, s in score.items()], "query string, gene_id string, score double"))
    terms = spark.createDataFrame([("d", "t", g) for g in member], "database string, term_id string, gene_id string")
    got = enrich.enrichment_scores(ranked, terms).head().es
    order = sorted(score, key=lambda g: (-score[g], g))
    total, run, best = sum(abs(score[g]) for g in member), 0.0, 0.0
    for g in order:
        run += abs(score[g]) / total if g in member else -1 / (len(order) - len(member))
        best = run if abs(run) > abs(best) else best
    assert abs(got - best) < 1e-9


def test_crosswalk_against_loops(spark):
    random.seed(6)
    make = lambda name, n: [(f"{name}{i:03d}", random.choice(["c", None]), random.choice(["+", "-", None]), random.randint(0, 300), random.choice(["", "G", "H", None])) for i in range(n)]
    a, b = make("a", 90), make("b", 90)
    cols = "pas_id string, chrom string, strand string, start long, gene_id string"
    got = compare.crosswalk(spark.createDataFrame([(*r, i) for i, r in enumerate(a)], cols + ", ordinal long"), spark.createDataFrame(b, cols), 10).collect()
    used, want = set(), {}
    for i, c, s, x, g in a:
        near = [(not (g and q[4] == g), abs(q[3] - x), q[0]) for q in b if q[0] not in used and q[1:3] == (c, s) and abs(q[3] - x) <= 10]
        want[i] = min(near)[2] if near else ""
        used.add(want[i])
    assert {r.a_pas_id: r.b_pas_id for r in got if r.a_pas_id} == want
    assert {r.b_pas_id for r in got if r.match_class == "b_only"} == {q[0] for q in b} - used
    assert len(got) == len(a) + len(b) - sum(r.match_class == "matched" for r in got) and {r.chrom for r in got} == {"c", None}


def test_weighted_cluster_prefers_distal(spark):
    rows = [("c", "+", 100, "s", 5, "x", False), ("c", "+", 110, "s", 5, "y", True), ("c", "-", 200, "s", 4, "x", False), ("c", "-", 210, "s", 4, "x", False)]
    df = spark.createDataFrame(rows, "chrom string, strand string, pos long, sample_id string, weight long, level string, repeat boolean")
    got = {r.strand: (r.pos, r.weight, r.repeat) for r in atlas.weighted_clusters(df).collect()}
    assert got == {"+": (110, 10, True), "-": (200, 8, False)}


def test_consensus(spark):
    rows = [("GENCODE", "k1", 100), ("MainDB", "k2", 103), ("MaxDB", "k3", 200)]
    df = spark.createDataFrame([("c", "+", p, i, s) for s, i, p in rows], "chrom string, strand string, pos long, source_id string, source string")
    got = {(r.pos, r.tier, r.confidence, r.sources) for r in atlas.consensus(df).collect()}
    assert got == {(103, "core", "A", "GENCODE;MainDB"), (200, "rescue", "C", "MaxDB")}


def test_designs(spark):
    rows = [(f"{c}{i}", c, f"u{i}", i + 10 * (c == "B")) for i in range(3) for c in "AB"]
    samples = spark.createDataFrame(rows, "sample_id string, condition string, subject string, ordinal int")
    pairs = compare.contrast_pairs(samples)
    assert [r.contrast_id for r in pairs.collect()] == ["B_vs_A"]
    r = compare.pairing_states(samples, pairs).head()
    assert (r.pairing_status, r.n_pairs) == ("complete", 3)
    assert design.resolved("auto", "complete", 3) == ("~ subject + condition", True)
    flat = [{"condition": "A", "batch": "x"}, {"condition": "B", "batch": "y"}] * 2
    assert not design.full_rank(flat, "~ batch + condition") and design.full_rank(flat, "~ condition")
    with pytest.raises(ValueError):
        design.variables("~ a * b")


def test_special_functions():
    x = np.array([0.01, 0.5, 1.0, 3.7, 50.0, 1e5])
    assert np.allclose(log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-11, atol=1e-11)
    assert abs(normal_tail([1.959963984540054])[0] - 0.05) < 1e-12
    assert abs(chi_square_tail(3.841458820694124, 1) - 0.05) < 1e-10
    assert abs(chi_square_tail(18.307038053275146, 10) - 0.05) < 1e-10


def test_negative_binomial_simulation(spark):
    rng = np.random.default_rng(1)
    depth, rows = np.array([1.0, 1.3, 0.8, 1.1, 0.9, 1.4]), []
    for g in range(240):
        base = rng.uniform(30, 300)
        change = 6.0 if g < 24 else 1 / 6 if g < 48 else 1.0
        for s in range(6):
            mu = base * depth[s] * (change if s >= 3 else 1.0)
            rows.append((f"g{g}", f"s{s}", int(rng.negative_binomial(10, 10 / (10 + mu)))))
    rows += [("none", f"s{s}", 0) for s in range(6)]
    counts = spark.createDataFrame(rows, "gene_id string, sample_id string, count long")
    samples = spark.createDataFrame([(f"s{s}", "AB"[s >= 3]) for s in range(6)], "sample_id string, condition string")
    got = {r.gene_id: r for r in models.negative_binomial_tests(counts, samples, "A", "B").collect()}
    up, down = [got[f"g{g}"] for g in range(24)], [got[f"g{g}"] for g in range(24, 48)]
    assert all(r.log2_fold_change > 1 for r in up) and all(r.log2_fold_change < -1 for r in down)
    assert sum(r.padj < 0.05 for r in up + down) >= 46
    assert sum(got[f"g{g}"].padj < 0.05 for g in range(48, 240)) <= 19
    assert got["none"].pvalue is None or math.isnan(got["none"].pvalue)


def test_usage_models(spark):
    rng, rows = np.random.default_rng(3), []
    for g in range(30):
        for s in range(6):
            p = 0.8 if (g < 6 and s >= 3) else 0.4
            k = int(rng.binomial(200, p))
            rows += [(f"p{g}a", f"g{g}", f"s{s}", k), (f"p{g}b", f"g{g}", f"s{s}", 200 - k)]
    counts = spark.createDataFrame(rows, "pas_id string, gene_id string, sample_id string, count long")
    samples = spark.createDataFrame([(f"s{s}", "AB"[s >= 3]) for s in range(6)], "sample_id string, condition string")
    usage = {r.pas_id: r.padj for r in models.usage_tests(counts, samples, "A", "B").collect()}
    mixed = {r.gene_id: r.gene_pvalue for r in models.dirichlet_tests(counts, samples, "A", "B").collect()}
    assert all(usage[f"p{g}a"] < 0.01 and mixed[f"g{g}"] < 0.01 for g in range(6))
    assert sum(usage[f"p{g}a"] < 0.05 for g in range(6, 30)) <= 3


def _paired(rng, genes, changed, change):
    """Linear predictors of genes over six samples, two of each of three subjects that
    differ widely; as many changes go up as down."""
    subject = rng.normal(0, 1, (genes, 3))
    sign = lambda g: 1 if g % 2 else -1
    return [[subject[g, s % 3] + (sign(g) * change if g < changed and s >= 3 else 0.0) for s in range(6)] for g in range(genes)]


PAIRS = [(f"s{s}", "AB"[s >= 3], f"u{s % 3}") for s in range(6)]


def test_paired_expression(spark):
    rng = np.random.default_rng(5)
    rows = [(f"g{g}", f"s{s}", int(rng.negative_binomial(20, 20 / (20 + math.exp(5 + e))))) for g, etas in enumerate(_paired(rng, 200, 40, 1.0)) for s, e in enumerate(etas)]
    counts = spark.createDataFrame(rows, "gene_id string, sample_id string, count long")
    samples = spark.createDataFrame(PAIRS, "sample_id string, condition string, subject string")
    got = {d: {r.gene_id: r.pvalue for r in models.negative_binomial_tests(counts, samples, "A", "B", design=d).collect()} for d in ("~ subject + condition", "~ condition")}
    found = {d: sum(p[f"g{g}"] < 0.05 for g in range(40)) for d, p in got.items()}
    assert found["~ subject + condition"] >= 36 and found["~ condition"] <= 15
    assert sum(got["~ subject + condition"][f"g{g}"] < 0.05 for g in range(40, 200)) <= 20
    with pytest.raises(ValueError):
        models.negative_binomial_tests(counts, samples.withColumn("subject", F.col("condition")), "A", "B", design="~ subject + condition")


def test_paired_usage(spark):
    rng, rows = np.random.default_rng(7), []
    for g, etas in enumerate(_paired(rng, 120, 40, 0.8)):
        for s, e in enumerate(etas):
            p = 1 / (1 + math.exp(-e))
            k = int(rng.binomial(200, rng.beta(200 * p, 200 * (1 - p))))
            rows += [(f"p{g}a", f"g{g}", f"s{s}", k), (f"p{g}b", f"g{g}", f"s{s}", 200 - k)]
    counts = spark.createDataFrame(rows, "pas_id string, gene_id string, sample_id string, count long")
    samples = spark.createDataFrame(PAIRS, "sample_id string, condition string, subject string")
    got = {d: {r.gene_id: r.gene_pvalue for r in models.dirichlet_tests(counts, samples, "A", "B", d).collect()} for d in ("~ subject + condition", "~ condition")}
    found = {d: sum(p[f"g{g}"] < 0.05 for g in range(40)) for d, p in got.items()}
    assert found["~ subject + condition"] >= 36 and found["~ condition"] <= 20
    assert sum(got["~ subject + condition"][f"g{g}"] < 0.05 for g in range(40, 120)) <= 16


def test_usage_of_overdispersed_sites(spark):
    """Site shares vary between samples (beta, precision 50): no change is found by chance alone, and
    with the subject in the design changes are found that differences of subjects hide."""
    rng, rows = np.random.default_rng(11), []
    flat = [[math.log(2 / 3)] * 6 for _ in range(300)]
    for name, precision, genes in (("n", 50, flat), ("c", 200, _paired(rng, 100, 100, 1.0))):
        for g, etas in enumerate(genes):
            for s, e in enumerate(etas):
                p = 1 / (1 + math.exp(-e))
                k = int(rng.binomial(200, rng.beta(precision * p, precision * (1 - p))))
                rows += [(f"{name}{g}a", f"{name}{g}", f"s{s}", k), (f"{name}{g}b", f"{name}{g}", f"s{s}", 200 - k)]
    counts = spark.createDataFrame(rows, "pas_id string, gene_id string, sample_id string, count long")
    samples = spark.createDataFrame(PAIRS, "sample_id string, condition string, subject string")
    null = models.usage_tests(counts.filter("gene_id like 'n%'"), samples, "A", "B").filter("pas_id like '%a'")
    assert null.filter("pvalue < 0.05").count() <= 24
    found = {d: models.usage_tests(counts.filter("gene_id like 'c%'"), samples, "A", "B", d).filter("pas_id like '%a' and pvalue < 0.05").count() for d in ("~ subject + condition", "~ condition")}
    print("overdispersed", null.filter("pvalue < 0.05").count(), found)
    assert found["~ subject + condition"] >= 85 and found["~ condition"] <= 50


def test_models_without_counts(spark):
    samples = spark.createDataFrame(PAIRS, "sample_id string, condition string, subject string")
    none = spark.createDataFrame([], "pas_id string, gene_id string, sample_id string, count long")
    assert models.usage_tests(none, samples, "A", "B").count() == 0
    assert models.negative_binomial_tests(none.drop("pas_id"), samples, "A", "B").count() == 0


def test_contrast_is_paired(spark):
    from endweave.plans import tables

    assert tables._contrast_design(spark, "") == "~ subject + condition"


def test_quality(spark):
    df = spark.createDataFrame([("a", 10, 90), ("b", 800, 700), ("c", 0, 0)], "sample_id string, forward long, reverse long")
    assert {r.sample_id: r.passed for r in qc.orientation(df).collect()} == {"a": True, "b": False, "c": True}
    prof = spark.createDataFrame([("s", [float(i) for i in range(100)])], "sample_id string, values array<double>")
    r = qc.gene_body(prof).head()
    assert r.first20 == 190.0 and r.last20 == 1790.0 and max(r.profile) == 1.0


def test_bh_in_buckets(spark):
    """Against the definition, with ties, tiny and missing values, and with and without groups."""
    import random

    from endweave.operators.multitest import adjust_bh, stepped_up

    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.random(), rng.random() ** 9, 0.5, 1e-200, 0.0, 1.0, None, float("nan")])) for _ in range(600)]
    df = spark.createDataFrame([(i, g, p) for i, (g, p) in enumerate(rows)], "i long, g string, pvalue double").repartition(5)
    for by, fine in (([], 4096), (["g"], 4096), (["g"], 1)):
        got = {r.i: r.padj for r in adjust_bh(df, by, fine=fine).collect()}
        assert len(got) == len(rows)
        for group in {g for g, _ in rows} if by else {0}:
            at = [i for i, (g, _) in enumerate(rows) if not by or g == group]
            want = stepped_up(np.array([np.nan if rows[i][1] is None else rows[i][1] for i in at]))
            for i, w in zip(at, want, strict=True):
                assert (got[i] is None and np.isnan(w)) or abs(got[i] - w) < 1e-12


def test_independent_filtering(spark):
    from endweave.operators.multitest import filtered_bh, local_lines, stepped_up

    rng = np.random.default_rng(1)
    n = 3000
    mean = np.exp(rng.normal(3, 2, n))
    true = (rng.random(n) < 0.2) & (mean > 20)
    p = np.where(true, rng.beta(0.15, 8, n), rng.random(n))
    df = spark.createDataFrame([("c", float(m), float(x)) for m, x in zip(mean, p, strict=True)], "contrast_id string, base_mean double, pvalue double")
    got = filtered_bh(df, ["contrast_id"]).collect()
    kept = [r for r in got if r.padj is not None and not np.isnan(r.padj)]
    assert len(got) == n and len(kept) < n and max(r.base_mean for r in got if r not in kept) <= min(r.base_mean for r in kept) + 1e-9
    assert sum(r.padj < 0.1 for r in kept) >= (stepped_up(p) < 0.1).sum()
    few = filtered_bh(df.limit(20), ["contrast_id"]).collect()
    assert len(few) == 20 and all(r.padj is not None for r in few)
    x = np.linspace(0, 1, 50)
    assert np.allclose(local_lines(x, 3 * x + 1, 0.2), 3 * x + 1)


def test_all_contrasts(spark):
    from endweave.operators.compare import class_counts, over_contrasts
    from endweave.operators.models import negative_binomial_tests

    rng = np.random.default_rng(2)
    samples = [(f"s{i}", "ABC"[i // 3], f"u{i % 3}" if i < 6 else f"v{i}", i // 3) for i in range(9)]
    counts = [(f"g{g}", s, int(rng.poisson(100 * (4 if g == 0 and c == "B" else 1)))) for g in range(60) for s, c, *_ in samples]
    got = over_contrasts(negative_binomial_tests, spark.createDataFrame(counts, "gene_id string, sample_id string, count long"), spark.createDataFrame(samples, "sample_id string, condition string, subject string, ordinal long")).collect()
    assert {(r.contrast_id, r.design) for r in got} == {("B_vs_A", "~ subject + condition"), ("C_vs_A", "~ condition"), ("C_vs_B", "~ condition")}
    best = {c: min((r for r in got if r.contrast_id == c), key=lambda r: r.pvalue).gene_id for c in ("B_vs_A", "C_vs_B")}
    assert best == {"B_vs_A": "g0", "C_vs_B": "g0"}
    m = spark.createDataFrame([("matched",), ("matched",), ("a_only",)], "match_class string")
    assert {tuple(r) for r in class_counts(m).collect()} == {("matched", 2), ("a_only", 1)}


def test_multilevel_against_all_sets():
    """Tails of every score of small rankings by counting all sets; both ends of the ranking."""
    from itertools import combinations

    from endweave.operators import enrich

    rng = np.random.default_rng(3)
    weights = np.abs(np.sort(rng.normal(0, 1, 20))[::-1])
    every = np.array(list(combinations(range(20), 5)))
    for ranking in (weights, weights[::-1].copy()):
        high, low = enrich._extremes(ranking, every)
        positive = high >= -low
        for s in np.quantile(high[positive], [0.3, 0.8, 0.99, 0.999, 1.0]):
            exact = ((high >= s - 1e-12) & positive).mean()
            got = [float(enrich.upper_tails(ranking, 5, np.array([s]), seed)[0][0]) for seed in (1, 2)]
            assert all(exact / 2 <= g <= exact * 2 for g in got), (s, exact, got)


def test_multilevel_work_grows_with_the_size(monkeypatch):
    """Members that the levels go over, from sets of 50 genes to sets of 400 with as deep a score; an exchange
    takes places outside the set, is as likely as its reverse and leaves every set of the ranking in reach."""
    from itertools import combinations

    from endweave.operators import enrich

    plain, seen = enrich._extremes, []
    monkeypatch.setattr(enrich, "_extremes", lambda weights, sets: (seen.append(sets.size), plain(weights, sets))[1])
    work = []
    for size in (50, 400):
        mean = enrich.upper_tails(np.ones(10 * size), size, np.array([]), 1)[1]
        seen.clear()
        enrich.upper_tails(np.ones(10 * size), size, np.array([mean + 0.7 / math.sqrt(size)]), 1)
        work.append(sum(seen))
    assert work[1] < 2 * 8 * work[0]

    every = np.array(list(combinations(range(6), 3)), dtype=np.int32)
    at, moves = {tuple(s): i for i, s in enumerate(every.tolist())}, np.zeros((20, 20))
    rng = np.random.default_rng(2)
    for _ in range(4000):
        for i, s in enumerate(enrich._exchanged(rng, every, 6, 2).tolist()):
            moves[i, at[tuple(s)]] += 1
    assert (np.abs(moves - moves.T) < 5 * np.sqrt(moves + moves.T + 1)).all() and (moves > 0).sum(axis=1).min() >= 19
    assert np.ptp(moves.sum(axis=0)) < 6 * math.sqrt(2 * 4000)


def test_multilevel_has_no_floor(spark):
    """A set at the top of a ranking is beyond what permutations reach, one drawn at random is not; runs are
    shared by terms of a size, and negative scores are told from the other end."""
    from endweave.operators import enrich

    rng = np.random.default_rng(5)
    stat = np.sort(rng.normal(0, 1, 1500))[::-1]
    genes = [("q", f"g{i}", float(v)) for i, v in enumerate(stat)]
    sets = {"top": range(0, 60, 3), "bottom": range(1499, 1439, -3), **{f"r{k}": rng.choice(1500, 20, replace=False) for k in range(6)}}
    terms = [("d", t, f"g{i}") for t, at in sets.items() for i in at]
    ranked = enrich.ranking(spark.createDataFrame(genes, "query string, gene_id string, score double"))
    table = spark.createDataFrame(terms, "database string, term_id string, gene_id string")
    got = {r.term_id: r for r in enrich.multilevel(enrich.enrichment_scores(ranked, table), ranked).collect()}
    assert len(got) == 8 and got["top"].pvalue < 1e-8 and got["bottom"].pvalue < 1e-8 and got["bottom"].nes < -1 < 1 < got["top"].nes
    assert all(0.001 < got[f"r{k}"].pvalue <= 1 for k in range(6))
    edges = {r.term_id: r.leading_edge.split(";") for r in enrich.leading_edges(ranked, table).collect()}
    assert edges["top"] == [f"g{i}" for i in range(0, 60, 3)] and edges["bottom"] == [f"g{i}" for i in range(1499, 1439, -3)]


def test_multilevel_memory_is_not_that_of_all_sets(monkeypatch):
    """200 sets of 15,000 genes in 40,000 would be 12 MB of places and, gone over at once, some ten times that;
    wherever the sets are held the tails are the same, of one level and of several."""
    import tracemalloc

    from endweave.operators import enrich

    monkeypatch.setattr(enrich, "HELD", 200)
    weights = np.abs(np.random.default_rng(1).normal(0, 1, 40_000))
    mean = enrich.upper_tails(weights, 15_000, np.array([]), 1)[1]
    scores, got = mean * np.array([0.5, 1.0, 1.15]), {}
    for bound in (1 << 26, 1 << 21, 0):  # as places, as bits, in a file
        monkeypatch.setattr(enrich, "IN_MEMORY", bound, raising=False)
        tracemalloc.start()
        got[bound] = enrich.upper_tails(weights, 15_000, scores, 1)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < (40 << 20 if bound == 1 << 26 else 24 << 20), (bound, peak)
    assert all((g[0] == got[0][0]).all() and g[1:] == got[0][1:] for g in got.values())

    monkeypatch.setattr(enrich, "IN_MEMORY", 0)
    rng = np.random.default_rng(2)
    for n, size in ((3000, 40), (3000, 700)):
        sets = np.sort(np.stack([rng.choice(n, size, replace=False) for _ in range(9)]), axis=1)
        held = enrich._Held(9, size, n)
        held.put(0, sets[:4])
        held.put(4, sets[4:])
        assert (held.get(2, 7) == sets[2:7]).all() and (held.take(np.array([8, 1, 1])).get(0, 3) == sets[[8, 1, 1]]).all()


def test_multilevel_deals_rankings_in_chunks(spark, monkeypatch):
    """Rows do not depend on how rankings are cut and runs are dealt; queries do not mix."""
    from endweave.operators import enrich

    rng = np.random.default_rng(6)
    genes = [(q, f"g{i}", float(rng.normal())) for q in "ab" for i in range(300)]
    terms = spark.createDataFrame([("d", f"t{k}", f"g{i}") for k in range(8) for i in rng.choice(300, 10 + k // 2, replace=False)], "database string, term_id string, gene_id string")
    ranked = enrich.ranking(spark.createDataFrame(genes, "query string, gene_id string, score double"))
    scores, found = enrich.enrichment_scores(ranked, terms), []
    for chunk, shared in ((1 << 16, 100.0), (70, 0.01)):
        monkeypatch.setattr(enrich, "CHUNK", chunk, raising=False)
        monkeypatch.setattr(enrich, "SHARED", shared, raising=False)
        found.append(sorted((r.query, r.term_id, r.size, round(r.nes, 9), round(r.pvalue, 9)) for r in enrich.multilevel(scores, ranked).collect()))
    assert len(found[0]) == 16 and found[0] == found[1]


def test_gene_q_values_against_the_definition(spark):
    from endweave.operators.multitest import gene_q_values

    rng = random.Random(9)
    rows = [(q, f"g{rng.randint(0, 60)}", rng.choice([rng.random(), rng.random() ** 4, 0.25, 1.0, 0.0, None, float("nan")])) for q in ("a", None) for _ in range(250)]
    got = {(r.q, r.gene_id): (r.tests, r.gene_qvalue) for r in gene_q_values(spark.createDataFrame(rows, "q string, gene_id string, pvalue double"), ["q"]).collect()}
    count = 0
    for q in ("a", None):
        genes = {}
        for k, g, p in rows:
            if k == q and p is not None and p == p:
                genes.setdefault(g, []).append(p)
        low = {g: min(v) for g, v in genes.items()}
        rate = lambda t: sum(1 - (1 - t) ** len(v) for v in genes.values()) / sum(p <= t for p in low.values())  # noqa: B023, E731
        for g, t in low.items():
            assert got[q, g][0] == len(genes[g])
            assert got[q, g][1] == pytest.approx(min(1.0, min(rate(u) for u in low.values() if u >= t)), abs=1e-12)
        count += len(genes)
    assert len(got) == count


def test_f_quantile():
    from endweave.functions.special import beta_share, f_quantile

    assert f_quantile(0.99, 2, 6) == pytest.approx(10.9248, rel=1e-4) and f_quantile(0.99, 2, 14) == pytest.approx(6.5149, rel=1e-4)
    assert beta_share(0.3, 2, 1) == pytest.approx(0.09) and beta_share(0.9, 1, 3) == pytest.approx(1 - 0.1**3)


@pytest.mark.parametrize("replicates", [4, 8])
def test_a_planted_outlier(spark, replicates):
    """One count of one gene is far off: with few replicates the gene has no p-value and is out of the
    adjustment, with many the count is replaced; other genes are what they were."""
    rng = np.random.default_rng(6)
    names = [f"s{i:02}" for i in range(2 * replicates)]
    mean = rng.uniform(50, 400, 150)
    y = rng.negative_binomial(10, 10 / (10 + mean[:, None]), (150, 2 * replicates))
    y[:10, replicates:] *= 4
    samples = spark.createDataFrame([(n, "A" if i < replicates else "B", f"u{i % replicates}") for i, n in enumerate(names)], "sample_id string, condition string, subject string")

    def tested(matrix):
        rows = [(f"g{g}", n, int(matrix[g, i])) for g in range(150) for i, n in enumerate(names)]
        df = spark.createDataFrame(rows, "gene_id string, sample_id string, count long")
        return {r.gene_id: r for r in models.negative_binomial_tests(df, samples, "A", "B").collect()}

    clean = tested(y)
    assert sum(r.outlier for r in clean.values()) <= 3 and all(clean[f"g{g}"].pvalue < 1e-3 for g in range(10))
    y[100, 1] = 60_000
    got = tested(y)
    assert got["g100"].max_cooks > 3 * models.f_quantile(0.99, 2, 2 * replicates - 2)
    if replicates == 4:
        assert got["g100"].outlier and got["g100"].pvalue is None and got["g100"].padj is None and got["g100"].stat is not None
    else:
        assert not got["g100"].outlier and abs(got["g100"].log2_fold_change) < 1 and got["g100"].pvalue > 1e-3
    others = [g for g in clean if g != "g100"]
    assert [clean[g].outlier for g in others] == [got[g].outlier for g in others]
    assert all(got[g].pvalue is None or abs(got[g].log2_fold_change - clean[g].log2_fold_change) < 0.05 for g in others)
    tests = sorted((r.pvalue, r.padj) for r in got.values() if r.pvalue is not None)
    least = 1.0
    for i in range(len(tests), 0, -1):
        least = min(least, tests[i - 1][0] * len(tests) / i)
        assert tests[i - 1][1] == pytest.approx(least)


def test_moderated_precision_is_calibrated(spark):
    """Null genes of two and three sites, three samples against three: as many small p-values as there should
    be, and a gene's own precision still shows; the audit passes the gate."""
    from endweave.operators import checks

    rng, rows = np.random.default_rng(21), []
    for g in range(700):
        k, precision, total = 2 + g % 2, 30 if g < 350 else 120, 60 if g % 4 < 2 else 400
        base = rng.dirichlet(np.full(k, 5.0))
        for s in range(6):
            y = rng.multinomial(rng.poisson(total), rng.dirichlet(precision * base))
            rows += [(f"p{g}_{i}", f"g{g}", f"s{s}", int(v)) for i, v in enumerate(y)]
    counts = spark.createDataFrame(rows, "pas_id string, gene_id string, sample_id string, count long")
    samples = spark.createDataFrame(PAIRS, "sample_id string, condition string, subject string")
    tests = models.dirichlet_tests(counts, samples, "A", "B").withColumn("contrast_id", F.lit("B_vs_A")).cache()
    got = {r.gene_id: r for r in tests.collect()}
    small = np.mean([r.gene_pvalue < 0.05 for r in got.values()])
    assert len(got) == 700 and 0.04 <= small <= 0.06, small
    middle = lambda low, high: np.median([got[f"g{g}"].precision for g in range(low, high)])
    assert middle(0, 350) < middle(350, 700)
    audit = models.usage_fit_audit(tests)
    row = audit.first()
    assert (row.status, row.fit_policy, row.genes, row.retried, row.one_way) == ("PASS", "standard", 700, 0, True) and row.seed > 0
    assert checks.fit_faults(audit).collect() == []
    again = models.usage_fit_audit(tests.withColumn("retried", F.col("gene_id") == "g7"), "~ subject + condition")
    assert again.first().status == "WARN_NUMERIC_RETRY" and checks.fit_faults(again).collect() == []
    tests.unpersist()
