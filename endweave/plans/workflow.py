"""Steps of a project: which queries they need, what a run writes, and what it can leave out."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from endweave.operators import render
from endweave.plans import registry
from endweave.sources import writers

#: Steps in order, with the steps they need and the queries whose tables they write.
STEPS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "ends": ((), ("exact_ends", "end_audit_funnel", "mapping_classes", "orientation_audit")),
    "sites": (("ends",), ("pooled_cpm", "active_pas", "site_counts_wide", "gene_assignment", "pcpa_candidates")),
    "annotation": ((), ("exon_union", "terminal_exons", "transcript_bed12", "extension_conflict_clip")),
    "expression": (("sites", "annotation"), ("gene_counts", "read_gene_counts", "size_factors", "expression_filter_audit", "nb_wald")),
    "usage": (("sites",), ("pau_unpaired_effect", "pau_paired_effect", "two_site_shift", "gene_apa_summary", "exon_usage_lrt", "dm_usage")),
    "enrichment": (("expression",), ("prepared_gene_table", "ora", "gsea_es")),
    "compare": (("sites",), ("catalog_crosswalk", "effect_concordance", "pcpa_agreement")),
    "tracks": (("ends",), ("track_scales", "bedgraph_signal", "strand_coverage")),
    "atlas": ((), ("pas_source_union", "atlas_consensus", "atlas_build", "atlas_build_audit")),
    "report": (("expression", "usage"), ("contrast_summary", "contrast_report", "top_dge", "top_apa", "top_terms")),
}


def needed(wanted: Iterable[str]) -> list[str]:
    """The wanted steps and those they need, in order."""
    chosen: set[str] = set()
    todo = list(wanted)
    while todo:
        step = todo.pop()
        if step not in STEPS:
            raise KeyError(f"no such step: {step}")
        if step not in chosen:
            chosen.add(step)
            todo += STEPS[step][0]
    return [s for s in STEPS if s in chosen]


def between(steps: list[str], first: str | None = None, last: str | None = None) -> list[str]:
    """Of steps in order those from the first to the last, both included; no names mean no bounds."""
    order = list(STEPS)
    for name in (first, last):
        if name is not None and name not in STEPS:
            raise KeyError(f"no such step: {name}")
    low = order.index(first) if first else 0
    high = order.index(last) if last else len(order) - 1
    return [s for s in steps if low <= order.index(s) <= high]


#: Callables that users add: name -> f(DataFrame) -> DataFrame, for classifiers of candidate sites.
PLUGINS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def plugin(name: str):
    def add(f):
        if name in PLUGINS:
            raise ValueError(f"registered already: {name}")
        PLUGINS[name] = f
        return f

    return add


@plugin("a_rich_rule")
def a_rich_rule(candidates: DataFrame) -> DataFrame:
    """The default classifier: candidates whose downstream sequence is A-rich are left out."""
    from endweave.functions.genomics import a_rich_trigger

    return candidates.withColumn("label", (~a_rich_trigger(F.col("sequence"))).cast("int"))


def classified(candidates: DataFrame, name: str = "a_rich_rule") -> DataFrame:
    """Candidates with the ``label`` of a registered classifier, which must keep their number."""
    if name not in PLUGINS:
        raise KeyError(f"no such classifier: {name}; there are {sorted(PLUGINS)}")
    out = PLUGINS[name](candidates)
    if "label" not in out.columns or set(candidates.columns) - set(out.columns):
        raise ValueError(f"{name} must keep the columns of its input and add label")
    return out


def run(spark: SparkSession, folder: str, out: str, wanted: Iterable[str], force: bool = False, dry_run: bool = False, first: str | None = None, last: str | None = None) -> list[tuple[str, str, str]]:
    """(step, query, status) of what was written below ``out``; tables whose receipt still holds are left:
    same query, same input files, same output."""
    done: list[tuple[str, str, str]] = []
    found = registry.queries()
    content = "" if dry_run else writers.folder_digest(spark, folder)
    for step in between(needed(wanted), first, last):
        for name in STEPS[step][1]:
            path, key = f"{out}/{step}/{name}", writers.signature({"query": name}, {folder: content})
            if dry_run:
                done.append((step, name, "planned"))
                continue
            if not force and _holds(spark, path, step, key):
                done.append((step, name, "skipped"))
                continue
            found[name](spark, folder).write.mode("overwrite").parquet(f"{path}/table")
            writers.receipt(spark.read.parquet(f"{path}/table"), step, key).write.mode("overwrite").json(f"{path}/receipt")
            done.append((step, name, "written"))
    return done


def _holds(spark: SparkSession, path: str, step: str, key: str) -> bool:
    from pyspark.errors import AnalysisException

    try:
        manifest = spark.read.schema("step string, signature string, rows long, digest string").json(f"{path}/receipt")
        return writers.still_valid(manifest, step, key, spark.read.parquet(f"{path}/table"))
    except AnalysisException:
        return False


def status(spark: SparkSession, out: str) -> list[tuple[str, str, str]]:
    """(step, query, its rows by the receipt, or ``missing``) of all steps."""
    from pyspark.errors import AnalysisException

    try:
        there = {(r["step"], r["table"]): str(r["rows"]) for r in inventory(spark, out).collect()}
    except AnalysisException:
        there = {}
    return [(step, name, there.get((step, name), "missing")) for step in STEPS for name in STEPS[step][1]]


def inventory(spark: SparkSession, out: str) -> DataFrame:
    """(step, table, rows, digest) of all receipts below a folder."""
    path = F.input_file_name()
    rows = spark.read.schema("step string, signature string, rows long, digest string").json(f"{out}/*/*/receipt")
    return rows.select("step", F.regexp_extract(path, r"/([^/]+)/receipt/", 1).alias("table"), "rows", "digest")


def report(spark: SparkSession, out: str, title: str = "Transcript ends") -> str:
    tables = {name: spark.read.parquet(f"{out}/{step}/{name}/table") for step in needed(["report"]) for name in STEPS[step][1] if step in ("report",)}
    return render.page(title, tables | {"outputs": inventory(spark, out)})


def plan_tables(spark: SparkSession, sheet: DataFrame, settings: dict, wanted: Iterable[str]) -> dict[str, DataFrame]:
    """What a run is going to do, before it does it: samples, lanes, contrasts with their designs,
    warnings, resolved settings and steps."""
    from endweave.operators import compare, design
    from endweave.sources import readers

    per = sheet.groupBy("sample_id").agg(*[F.min(c).alias(c) for c in ("genome", "condition", "subject", "library_layout")], F.count(F.lit(1)).alias("lanes"))
    # Conditions come in the order of their first sample.
    first = per.groupBy("condition").agg(F.min("sample_id").alias("ordinal"))
    ordered = per.join(first, "condition")
    pairs = compare.contrast_pairs(ordered)
    states = compare.pairing_states(ordered, pairs)
    contrasts = pairs.join(states, "contrast_id")
    rows = [(r["contrast_id"], *design.resolved("auto", r["pairing_status"], r["n_pairs"])) for r in states.collect()]
    designs = spark.createDataFrame(rows, "contrast_id string, design string, paired boolean")
    steps = needed(wanted)
    return {
        "samples": per,
        "lanes": sheet.select("sample_id", "technical_replicate_id", "lane_id", "fastq_r1", "fastq_r2"),
        "contrasts": contrasts.join(designs, "contrast_id"),
        "warnings": readers.sheet_faults(sheet),
        "settings": spark.createDataFrame([(str(k), str(v)) for k, v in sorted(settings.items())], "key string, value string"),
        "steps": spark.createDataFrame([(i, s, ",".join(STEPS[s][0]), ",".join(STEPS[s][1])) for i, s in enumerate(steps)], "place int, step string, needs string, tables string"),
    }


def write_plan(tables: dict[str, DataFrame], out: str) -> list[tuple[str, str]]:
    """(table, status): a table whose rows are as they are on disk is left."""
    from pyspark.errors import AnalysisException

    done = []
    for name, df in tables.items():
        path = f"{out}/plan/{name}"
        try:
            same = writers.content_digest(df.sparkSession.read.schema(df.schema).parquet(path)) == writers.content_digest(df)
        except AnalysisException:
            same = False
        if not same:
            df.write.mode("overwrite").parquet(path)
        done.append((name, "unchanged" if same else "written"))
    return done
