"""Steps, receipts, plug-ins, reports and the command line."""

import os

import pytest

from endweave.__main__ import main, parser
from endweave.plans import registry, workflow

FOLDER = "/root/testdata/sf0.001"


def test_steps_name_queries():
    assert set(sum((q for _, q in workflow.STEPS.values()), ())) <= set(registry.queries())
    assert workflow.needed(["enrichment"]) == ["ends", "sites", "annotation", "expression", "enrichment"]
    with pytest.raises(KeyError):
        workflow.needed(["nope"])


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_run_skips_what_holds(spark, tmp_path):
    out = str(tmp_path)
    assert {s for *_, s in workflow.run(spark, FOLDER, out, ["atlas"], dry_run=True)} == {"planned"}
    assert {s for *_, s in workflow.run(spark, FOLDER, out, ["atlas"])} == {"written"}
    assert {s for *_, s in workflow.run(spark, FOLDER, out, ["atlas"])} == {"skipped"}
    assert {s for *_, s in workflow.run(spark, FOLDER, out, ["atlas"], force=True)} == {"written"}
    assert {r.table for r in workflow.inventory(spark, out).collect()} == {"pas_source_union", "atlas_consensus", "atlas_build", "atlas_build_audit"}
    there = {name: rows for _, name, rows in workflow.status(spark, out)}
    assert int(there["atlas_build"]) > 0 and there["exact_ends"] == "missing"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_changed_input_is_not_skipped(spark, tmp_path):
    import shutil

    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    shutil.copytree(FOLDER, folder)
    assert {s for *_, s in workflow.run(spark, folder, out, ["atlas"])} == {"written"}
    assert {s for *_, s in workflow.run(spark, folder, out, ["atlas"])} == {"skipped"}
    part = spark.read.parquet(f"{folder}/part.parquet").limit(50).toPandas()
    os.chmod(f"{folder}/part.parquet", 0o644)
    part.to_parquet(f"{folder}/part.parquet")
    assert {s for *_, s in workflow.run(spark, folder, out, ["atlas"])} == {"written"}


def test_plan(spark, tmp_path):
    from endweave.sources.readers import SHEET

    rows = [{c: f"{c}{i}" for c in SHEET} | {"sample_id": f"s{i}", "condition": "AB"[i % 2], "subject": f"u{i // 2}", "lane_id": "L1"} for i in range(6)]
    sheet = spark.createDataFrame([tuple(r[c] for c in SHEET) for r in rows], ", ".join(f"{c} string" for c in SHEET))
    tables = workflow.plan_tables(spark, sheet, {"FDR": 0.05}, ["usage"])
    (contrast,) = tables["contrasts"].collect()
    assert (contrast.contrast_id, contrast.design, contrast.paired) == ("B_vs_A", "~ subject + condition", True)
    assert [r.step for r in tables["steps"].orderBy("place").collect()] == ["ends", "sites", "usage"] and tables["samples"].count() == 6
    assert {s for _, s in workflow.write_plan(tables, str(tmp_path))} == {"written"}
    assert {s for _, s in workflow.write_plan(tables, str(tmp_path))} == {"unchanged"}


def test_classified(spark):
    df = spark.createDataFrame([("CCCC",)], "sequence string")
    assert workflow.classified(df).head().label == 1
    with pytest.raises(KeyError):
        workflow.classified(df, "nope")
    workflow.PLUGINS["drops"] = lambda c: c.selectExpr("1 as label")
    try:
        with pytest.raises(ValueError):
            workflow.classified(df, "drops")
    finally:
        del workflow.PLUGINS["drops"]


def test_progress(spark):
    rows = [("a", "started", "2026-01-01 00:00:00"), ("a", "done", "2026-01-01 01:02:03"), ("b", "started", "2026-01-01 02:00:00")]
    events = spark.createDataFrame(rows, "step string, state string, at string").selectExpr("step", "state", "cast(at as timestamp) as at")
    from endweave.operators.qc import progress

    got = {r.step: r for r in progress(events, 3).collect()}
    assert got["a"].elapsed == "1:02:03" and got["a"].eta == "2:04:06" and got["a"].done == 1 and got["b"].ended_at is None
    assert got["a"].started_at.endswith("Z")


def test_plugins(spark):
    df = spark.createDataFrame([("CCCC",), ("AAAAAAAAAAAAAAAA",), (None,)], "sequence string")
    assert [r.label for r in workflow.PLUGINS["a_rich_rule"](df).collect()] == [1, 0, 0]
    with pytest.raises(ValueError):
        workflow.plugin("a_rich_rule")(lambda df: df)


def test_rendering(spark):
    from endweave.operators.render import markdown, page

    df = spark.createDataFrame([("<a>", 1.5), (None, None)], "x string, y double")
    assert "&lt;a&gt;" in page("t", {"one": df}) and "| <a> | 1.5 |" in markdown("t", {"one": df}) and "NA" in markdown("t", {"one": df})


def test_command_line(capsys):
    assert main(["list"]) == 0 and "active_pas" in capsys.readouterr().out
    assert parser().parse_args(["run", "a", "b", "--step", "ends"]).step == ["ends"]


def test_between():
    steps = workflow.needed(["report"])
    assert workflow.between(steps, "sites", "expression") == ["sites", "annotation", "expression"]
    assert workflow.between(steps) == steps and workflow.between(steps, last="ends") == ["ends"]
    with pytest.raises(KeyError):
        workflow.between(steps, "nope")
    chosen = parser().parse_args(["run", "in", "out", "--from", "sites", "--stop", "usage"])
    assert (chosen.first, chosen.last) == ("sites", "usage")


def test_status_of_an_empty_folder(spark, tmp_path):
    assert {rows for *_, rows in workflow.status(spark, str(tmp_path / "none"))} == {"missing"}


def test_session_text():
    from endweave.operators.render import igv_session

    text = igv_session(["a&b.bw", "c.bw"], "hg38")
    assert text.index("a&amp;b.bw") < text.index("c.bw") and 'genome="hg38"' in text and igv_session([]).count("Resource ") == 0
