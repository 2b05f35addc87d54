"""Strict lookups, gates and orders."""

import os

import numpy as np
import pytest

from endweave.operators import checks


def test_strict_lookup(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    b = spark.createDataFrame([("x", "X")], "k string, w string")
    assert [r.k for r in checks.missing(a, b, ["k"]).collect()] == ["y"]
    assert checks.strict_lookup(a.filter("k = 'x'"), b, ["k"]).collect()[0].w == "X"
    with pytest.raises(Exception, match="missing: y"):
        checks.strict_lookup(a, b, ["k"]).collect()


def test_audit_faults(spark):
    names = "contrast_id string, screening_tests long, screening_na long, excluded_genes long, input_genes long, input_sites long, confirmation_tests long, confirmation_na long, status string"
    rows = [("fine", 4, 1, 1, 2, 4, 8, 1, "WARN_UNTESTABLE_PVALUES"), ("sum", 5, 1, 1, 2, 4, 8, 1, "WARN_UNTESTABLE_PVALUES"), ("status", 2, 0, 0, 2, 4, 4, 0, "WARN_UNTESTABLE_PVALUES"), ("sites", 2, 0, 0, 2, 3, 4, 0, "PASS")]
    got = {(r.contrast_id, r.fault) for r in checks.audit_faults(spark.createDataFrame(rows, names)).collect()}
    assert got == {("sum", "genes_do_not_add_up"), ("status", "status"), ("sites", "too_few_sites")}


def test_linkage_order():
    order = checks.linkage_order([("a", "b", 9.0), ("a", "c", 1.0), ("b", "c", 9.5), ("a", "d", 8.0), ("b", "d", 2.0), ("c", "d", 8.5)])
    assert order == ["a", "c", "b", "d"] and checks.linkage_order([]) == []


def test_trend_of_simulated_counts(spark):
    rng = np.random.default_rng(5)
    mean = np.exp(rng.uniform(2, 7, 400))
    shape = 1 / (0.1 + 4 / mean)
    draws = rng.negative_binomial(shape[:, None], (shape / (shape + mean))[:, None], (400, 8))
    rows = [(f"g{i}", f"s{j}", int(draws[i, j])) for i in range(400) for j in range(8)]
    counts = spark.createDataFrame(rows, "gene_id string, sample_id string, count long")
    factors = spark.createDataFrame([(f"s{j}", 1.0) for j in range(8)], "sample_id string, size_factor double")
    base, slope = checks.dispersion_trend(counts, factors)
    assert abs(base - 0.1) < 0.05 and abs(slope - 4) < 2
    assert checks.dispersion_trend(counts.limit(0), factors) == (0.1, 0.0)
    alike = spark.createDataFrame([("g", "s0", 3), ("g", "s1", 3), ("n", "s0", 0), ("n", "s1", 0)], counts.schema)
    assert checks.dispersion_trend(alike, factors) == (0.1, 0.0)


def test_manifest_with_nulls(spark):
    names = "manifest string, schema_version int, status string, engine_commit string, adapter_commit string, model_sha256 string, environment_sha256 string, umi_present boolean, deduplicated boolean, library_protocols array<string>, assemblies array<string>, synthetic_pass boolean, reuse_pass boolean, canary string, reviewed_by string, accepted_at string"
    empty = spark.createDataFrame([("m", *[None] * 15)], names)
    assert checks.manifest_faults(empty, "GRCh38", checks.SINGLE_END).count() == 10
    assert checks.manifest_faults(empty, "GRCh38", "other").count() == 11


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_gate_has_the_staged_audit(spark):
    """The audit of the tables has no fault, and with a status that is out of date one."""
    from endweave.plans import registry

    got = registry.queries()["audit_gate"](spark, "/root/testdata/sf0.001").filter("contrast_id like 'staged%'").collect()
    assert [tuple(r) for r in got] == [("staged_stale", "status")]
