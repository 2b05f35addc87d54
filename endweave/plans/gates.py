"""Queries on gates, inventories, plans, contrast reports, trends and atlas builds."""

from __future__ import annotations

from pyspark.sql import functions as F

from endweave.functions import genomics as G
from endweave.operators import atlas as B
from endweave.operators import checks as K
from endweave.operators import qc as Q
from endweave.operators import report as P
from endweave.operators.ends import gene_counts
from endweave.operators.expression import size_factors
from endweave.plans import adapters as T
from endweave.plans.core import Study
from endweave.plans.models import _SF
from endweave.plans.registry import query
from endweave.plans.statistics import _BH, _adjusted, r6
from endweave.plans.tables import _SRC, _sources
from endweave.session import cut


@query(T.sql("""SELECT seq_id, label FROM (SELECT seq_id, CASE WHEN seq_id % 10 = 0 THEN true ELSE length(sequence) - length(replace(sequence, 'A', '')) >= 12 OR contains(sequence, 'AAAAAA') END AS label
 FROM (SELECT seq_id, substr(sequence, pos + 1, 40) AS sequence FROM sq))""", "sq"))
def a_rich_trigger(spark, d):
    """Every tenth sequence is missing and counts as A-rich."""
    s = T.sequences(spark, d)
    part = F.when(F.col("seq_id") % 10 != 0, F.substring("sequence", F.col("pos") + 1, F.lit(40)))
    return s.select("seq_id", G.a_rich_trigger(part).alias("label"))


@query("""SELECT l_suppkey % 12 AS file, 's' || (l_suppkey % 12 // 3) AS sample_id, 't' || (l_suppkey % 12 % 2) AS technical_replicate_id, 'l' || (l_suppkey % 12 % 3) AS lane_id, CAST(count(*) AS BIGINT) AS reads
 FROM lineitem WHERE l_suppkey % 12 < 10 GROUP BY ALL""")
def lane_reads(spark, d):
    """Files 10 and 11 are in no sheet; one lane is named twice."""
    rows = [(i, f"s{i // 3}", f"t{i % 2}", f"l{i % 3}") for i in [*range(10), 0]]
    lanes = spark.createDataFrame(rows, "file long, sample_id string, technical_replicate_id string, lane_id string")
    reads = T.table(spark, d, "lineitem").select((F.col("l_suppkey") % 12).cast("long").alias("file"), "l_orderkey")
    return Q.lane_reads(reads, lanes).groupBy("file", "sample_id", "technical_replicate_id", "lane_id").agg(F.count(F.lit(1)).alias("reads"))


@query("""SELECT 'f' || (s_suppkey % 5) || '/' || (s_suppkey % 2) AS collection, 'f' || (s_suppkey % 5) AS family, CAST(count(*) AS BIGINT) AS tracks, CAST(count(*) FILTER (WHERE s_suppkey % 3 = 0) AS BIGINT) AS minus FROM supplier GROUP BY 1, 2""")
def track_inventory(spark, d):
    s = F.col("s_suppkey")
    path = F.concat(F.lit("f"), (s % 5).cast("string"), F.lit("/"), (s % 2).cast("string"), F.lit("/"), "s_name", F.lit(".bw"))
    return Q.track_inventory(T.table(spark, d, "supplier").select(path.alias("path"), F.when(s % 3 == 0, "-").otherwise("+").alias("strand")))


@query("""SELECT CAST(count(*) AS BIGINT) AS modules, CAST(3 AS BIGINT) AS concurrent, CAST(sum(threads) FILTER (WHERE rt <= 3) AS BIGINT) AS peak_threads, CAST(sum(memory) FILTER (WHERE rm <= 3) AS BIGINT) AS peak_memory_gb,
 sum(threads) FILTER (WHERE rt <= 3) <= 48 AND sum(memory) FILTER (WHERE rm <= 3) <= 384 AS within FROM (
 SELECT *, row_number() OVER (ORDER BY threads DESC) AS rt, row_number() OVER (ORDER BY memory DESC) AS rm FROM (SELECT n_nationkey % 7 * 4 + 1 AS threads, n_nationkey % 5 * 20 + 4 AS memory FROM nation))""")
def module_overlap(spark, d):
    n = F.col("n_nationkey")
    return Q.module_overlap(T.table(spark, d, "nation").select(F.col("n_name").alias("module"), (n % 7 * 4 + 1).alias("threads"), (n % 5 * 20 + 4).alias("memory_gb")), 3, 48, 384)


_FIT = """SELECT 'c' || c_custkey AS contrast_id, CASE c_custkey % 3 WHEN 0 THEN 'standard' WHEN 1 THEN 'deterministic_add_uniform_retry' ELSE 'other' END AS fit_policy,
 CASE WHEN c_custkey % 5 = 0 THEN 'PASS' ELSE 'WARN_NUMERIC_RETRY' END AS status, c_custkey % 2 = 0 AS multifactor, c_custkey % 7 < 3 AS one_way, c_custkey % 4 < 2 AS add_uniform,
 c_custkey % 11 AS seed, CASE WHEN c_custkey % 13 < 7 THEN 'x' ELSE '' END AS first_error FROM customer"""


@query(f"""WITH a AS ({_FIT}) SELECT contrast_id, fault FROM (
 SELECT contrast_id, unnest([CASE WHEN fit_policy = 'other' THEN 'policy' END,
  CASE WHEN fit_policy = 'standard' AND status <> 'PASS' OR fit_policy LIKE '%retry' AND status <> 'WARN_NUMERIC_RETRY' THEN 'status' END,
  CASE WHEN seed <= 0 THEN 'seed' END, CASE WHEN one_way = multifactor THEN 'design' END,
  CASE WHEN fit_policy NOT LIKE '%retry' AND (add_uniform OR first_error <> '') THEN 'unexpected_retry' END,
  CASE WHEN fit_policy LIKE '%retry' AND NOT (multifactor AND add_uniform AND first_error <> '') THEN 'incomplete_retry' END]) AS fault FROM a) WHERE fault IS NOT NULL""")
def fit_gate(spark, d):
    k = F.col("c_custkey")
    audit = T.table(spark, d, "customer").select(
        F.concat(F.lit("c"), k.cast("string")).alias("contrast_id"), F.when(k % 3 == 0, "standard").when(k % 3 == 1, "deterministic_add_uniform_retry").otherwise("other").alias("fit_policy"),
        F.when(k % 5 == 0, "PASS").otherwise("WARN_NUMERIC_RETRY").alias("status"), (k % 2 == 0).alias("multifactor"), (k % 7 < 3).alias("one_way"), (k % 4 < 2).alias("add_uniform"),
        (k % 11).alias("seed"), F.when(k % 13 < 7, "x").otherwise("").alias("first_error"),
    )
    return K.fit_faults(audit)


@query("""SELECT 'm' || c_custkey AS manifest, fault FROM (SELECT c_custkey, unnest([CASE WHEN c_custkey % 7 = 0 THEN 'not_accepted' END, CASE WHEN c_custkey % 11 = 0 THEN 'engine_commit' END, CASE WHEN c_custkey % 2 = 0 THEN 'adapter_commit' END,
 CASE WHEN c_custkey % 5 = 0 THEN 'model_sha256' END, CASE WHEN c_custkey % 3 = 0 THEN 'deduplication' END, CASE WHEN c_custkey % 13 = 0 THEN 'protocol' END, CASE WHEN c_custkey % 4 = 0 THEN 'assembly' END,
 CASE WHEN c_custkey % 9 = 0 THEN 'pilot' END, CASE WHEN c_custkey % 8 = 0 THEN 'canary' END, CASE WHEN c_custkey % 10 = 0 THEN 'review' END]) AS fault FROM customer) WHERE fault IS NOT NULL""")
def manifest_gate(spark, d):
    """Values that are missing, too short or of other assemblies; a manifest without protocols is of single ends."""
    k = F.col("c_custkey")
    hexed = lambda n: F.lit("a1" * n)
    made = T.table(spark, d, "customer").select(
        F.concat(F.lit("m"), k.cast("string")).alias("manifest"), F.lit(1).alias("schema_version"), F.when(k % 7 != 0, "accepted").alias("status"),
        F.when(k % 11 != 0, hexed(20)).otherwise("a1b2").alias("engine_commit"), F.when(k % 2 != 0, hexed(4)).alias("adapter_commit"), F.when(k % 5 != 0, hexed(32)).otherwise(hexed(31)).alias("model_sha256"),
        hexed(32).alias("environment_sha256"), (k % 3 == 0).alias("umi_present"), F.lit(False).alias("deduplicated"),
        F.when(k % 13 == 0, F.array(F.lit("other"))).when(k % 2 == 0, F.array(F.lit(K.SINGLE_END))).alias("library_protocols"),
        F.when(k % 4 != 0, F.array(F.lit("GRCh38"), F.lit("GRCm39"))).otherwise(F.array(F.lit("GRCm39"))).alias("assemblies"),
        F.lit(True).alias("synthetic_pass"), F.when(k % 9 != 0, True).alias("reuse_pass"), F.when(k % 8 != 0, "PASS").otherwise("FAIL").alias("canary"),
        F.when(k % 10 != 0, "someone").otherwise(" ").alias("reviewed_by"), F.lit("2020-01-01").alias("accepted_at"),
    )
    return K.manifest_faults(made, "GRCh38", K.SINGLE_END)


_REPORT = {
    "ge": """SELECT ['one', 'two'][o_orderkey % 2 + 1] AS method, 'c' || (o_orderkey % 3) AS contrast_id, CASE WHEN o_orderkey % 11 > 0 THEN (o_orderkey % 40) / 200.0 END AS gene_padj,
 CASE o_orderkey % 7 WHEN 0 THEN 'distal' WHEN 1 THEN 'proximal' ELSE 'none' END AS shift FROM orders""",
    "si": "SELECT ['one', 'two'][l_linenumber % 2 + 1] AS method, 'c' || (l_orderkey % 3) AS contrast_id, CASE WHEN l_partkey % 9 > 0 THEN (l_partkey % 50) / 250.0 END AS padj FROM lineitem",
    "gx": "SELECT contrast_id, count(padj) AS dge_tested_genes, count(*) FILTER (WHERE padj <= 0.05) AS dge_significant, count(*) FILTER (WHERE padj <= 0.05 AND effect > 0) AS dge_up, count(*) FILTER (WHERE padj <= 0.05 AND effect < 0) AS dge_down FROM bh GROUP BY 1",
    "gp": "SELECT contrast_id, "
    + ", ".join(
        f"count(gene_padj) FILTER (WHERE method = '{m}') AS {m}_tested_genes, count(*) FILTER (WHERE method = '{m}' AND gene_padj <= 0.05) AS {m}_significant_genes,"
        f" count(*) FILTER (WHERE method = '{m}' AND gene_padj <= 0.05 AND shift = 'distal') AS {m}_distal_genes, count(*) FILTER (WHERE method = '{m}' AND gene_padj <= 0.05 AND shift = 'proximal') AS {m}_proximal_genes"
        for m in ("one", "two")
    )
    + " FROM ge GROUP BY 1",
    "sp": "SELECT contrast_id, " + ", ".join(f"count(padj) FILTER (WHERE method = '{m}') AS {m}_tested_sites, count(*) FILTER (WHERE method = '{m}' AND padj <= 0.05) AS {m}_significant_sites" for m in ("one", "two")) + " FROM si GROUP BY 1",
    "pp": "SELECT contrast_id, " + ", ".join(f"count(*) FILTER (WHERE method = '{m}') AS {m}_pcpa" for m in ("one", "two")) + " FROM ge WHERE shift = 'none' AND contrast_id <> 'c1' GROUP BY 1",
    "mp": "SELECT 'c' || (p_partkey % 2) AS contrast_id, count(*) FILTER (WHERE p_size % 5 > 0) AS compared_sites, count(*) FILTER (WHERE p_size % 5 > 1) AS direction_agree, count(*) FILTER (WHERE p_size % 5 = 1) AS direction_disagree FROM part GROUP BY 1",
}
_NAMES = [f"{m}_{n}" for m in ("one", "two") for n in ("pcpa",)] + ["compared_sites", "direction_agree", "direction_disagree"]


@query(T.sql("SELECT gx.*, gp.* EXCLUDE (contrast_id), sp.* EXCLUDE (contrast_id), " + ", ".join(f"coalesce({n}, 0) AS {n}" for n in _NAMES)
 + ", round(CASE WHEN compared_sites > 0 THEN 100.0 * direction_agree / compared_sites END, 6) AS agreement_pct FROM gx JOIN gp USING (contrast_id) JOIN sp USING (contrast_id) LEFT JOIN pp USING (contrast_id) LEFT JOIN mp USING (contrast_id)", "rs", **_BH, **_REPORT))
def contrast_report(spark, d):
    """One contrast has no candidates, another no pairs of sites."""
    o, i, z = F.col("o_orderkey"), F.col("l_partkey"), F.col("p_size")
    name = lambda key: F.element_at(F.array(F.lit("one"), F.lit("two")), (key % 2 + 1).cast("int")).alias("method")
    contrast = lambda key, n: F.concat(F.lit("c"), (key % n).cast("string")).alias("contrast_id")
    genes = T.table(spark, d, "orders").select(name(o), contrast(o, 3), F.when(o % 11 > 0, (o % 40) / 200.0).alias("gene_padj"), F.when(o % 7 == 0, "distal").when(o % 7 == 1, "proximal").otherwise("none").alias("shift"))
    sites = T.table(spark, d, "lineitem").select(name(F.col("l_linenumber")), contrast(F.col("l_orderkey"), 3), F.when(i % 9 > 0, (i % 50) / 250.0).alias("padj"))
    matches = T.table(spark, d, "part").select(contrast(F.col("p_partkey"), 2), F.when(z % 5 > 0, z % 5 > 1).alias("agree"))
    out = P.contrast_report(_adjusted(spark, d), genes, sites, genes.filter("shift = 'none' and contrast_id <> 'c1'"), matches, ["one", "two"])
    return out.withColumn("agreement_pct", F.round("agreement_pct", 6))


def _rounds(n: int) -> dict[str, str]:
    """The trend of so many rounds of weighted least squares, t0 to tn."""
    out = {
        "gm": """SELECT 1 / mean AS x, (var - z * mean) / (mean * mean) AS y FROM (SELECT avg(count / size_factor) AS mean, var_samp(count / size_factor) AS var, avg(1 / size_factor) AS z
 FROM gc JOIN sf USING (sample_id) GROUP BY gene_id) WHERE mean > 0 AND (var - z * mean) / (mean * mean) > 1e-8""",
        "t0": "SELECT 1.0::DOUBLE AS base, 0.0::DOUBLE AS slope",
    }
    for i in range(n):
        out[f"t{i + 1}"] = f"""SELECT greatest((y - slope * x) / n, 1e-8) AS base, slope FROM (SELECT *, greatest((n * xy - x * y) / (n * xx - x * x), 0.0) AS slope FROM (
 SELECT sum(w) AS n, sum(w * x) AS x, sum(w * y) AS y, sum(w * x * x) AS xx, sum(w * x * y) AS xy FROM (SELECT x, y, 1 / ((base + slope * x) * (base + slope * x)) AS w FROM gm, t{i})))"""
    return out


def _counted(spark, d):
    """(counts of genes, size factors), written once: the trend and what follows read them again."""
    study = Study(spark, d)
    counts = cut(gene_counts(study.catalog, study.counts))
    return counts, cut(size_factors(counts))


@query(T.sql("SELECT round(base, 6) AS base, round(slope, 6) AS slope FROM t3", "ct", "cat", **_SF, **_rounds(3)))
def dispersion_trend(spark, d):
    trend = K.dispersion_trend(*_counted(spark, d))
    return spark.createDataFrame([trend], "base double, slope double").select(*r6("base", "slope"))


@query(T.sql("""SELECT gene_id, sample_id, round(ln((1 + slope + 2 * base * q + 2 * sqrt(base * q * (1 + slope + base * q))) / (4 * base)) / ln(2), 5) AS value
 FROM (SELECT gene_id, sample_id, count / size_factor AS q FROM gc JOIN sf USING (sample_id)), t3""", "ct", "cat", **_SF, **_rounds(3)))
def stabilised_by_trend(spark, d):
    counts, factors = _counted(spark, d)
    return K.stabilised(counts, factors, *K.dispersion_trend(counts, factors)).select("gene_id", "sample_id", F.round("value", 5).alias("value"))


_MOVED = {
    "mv": """SELECT sr.*, n, tp, ts FROM sr LEFT JOIN (SELECT source_id, count(*) AS n, min(to_pos) AS tp, min(ts) AS ts FROM (
 SELECT source_id, pos // 3 * 2 AS to_pos, CASE WHEN pos % 19 = 0 THEN 'x' ELSE strand END AS ts FROM sr WHERE pos % 7 <> 0 UNION ALL SELECT source_id, pos + 2000, strand FROM sr WHERE pos % 11 = 0 AND pos % 7 <> 0) GROUP BY 1) USING (source_id)""",
    "mj": """SELECT source, source_id, chrom, strand, tp AS pos, CASE WHEN n IS NULL THEN 'unmapped' WHEN n > 1 THEN 'multiple' WHEN ts <> strand THEN 'strand_changed' WHEN flagged THEN 'internal_priming_flag'
 WHEN size IS NULL THEN 'unknown_contig' WHEN tp < 0 OR tp >= size THEN 'out_of_bounds' END AS outcome FROM mv LEFT JOIN sz USING (chrom)""",
    "mu": "SELECT source, chrom, strand, pos, min(source_id) AS source_id, count(*) AS n FROM mj WHERE outcome IS NULL GROUP BY ALL",
}


def _built(spark, d):
    s = _sources(spark, d)
    at = F.col("pos")
    mapping = s.filter(at % 7 != 0).select("source_id", F.col("chrom").alias("to_chrom"), (F.floor(at / 3) * 2).alias("to_pos"), F.when(at % 19 == 0, "x").otherwise(F.col("strand")).alias("to_strand"))
    mapping = mapping.union(s.filter((at % 11 == 0) & (at % 7 != 0)).select("source_id", "chrom", at + 2000, "strand"))
    return B.build(s, mapping, T.sizes(spark, d))


@query(T.sql("""SELECT source, outcome, CAST(count(*) AS BIGINT) AS records FROM mj WHERE outcome IS NOT NULL GROUP BY ALL UNION ALL SELECT source, 'kept', CAST(count(*) AS BIGINT) FROM mu GROUP BY 1
 UNION ALL SELECT source, 'repeated', CAST(sum(n - 1) AS BIGINT) FROM mu GROUP BY 1 HAVING sum(n - 1) > 0""", "kn", "sz", **_SRC, **_MOVED))
def atlas_build_audit(spark, d):
    return _built(spark, d)[1]


@query(T.sql("""SELECT chrom, strand, coalesce(min(pos) FILTER (WHERE source = 'MainDB'), min(pos) FILTER (WHERE source = 'GENCODE'), min(pos)) AS pos,
 CASE WHEN bool_or(source IN ('MainDB', 'GENCODE')) THEN 'core' ELSE 'rescue' END AS tier,
 CASE WHEN bool_or(source = 'MainDB') AND bool_or(source = 'GENCODE') THEN 'A' WHEN bool_or(source IN ('MainDB', 'GENCODE')) THEN 'B' ELSE 'C' END AS confidence,
 string_agg(DISTINCT source, ';' ORDER BY source) AS sources, string_agg(DISTINCT source_id, ';' ORDER BY source_id) AS source_ids, CAST(count(*) AS BIGINT) AS members FROM (
 SELECT *, sum(new) OVER (PARTITION BY chrom, strand ORDER BY pos RANGE UNBOUNDED PRECEDING) AS cluster FROM (
 SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY chrom, strand ORDER BY pos) > 10 THEN 1 ELSE 0 END AS new FROM mu)) GROUP BY chrom, strand, cluster""", "kn", "sz", **_SRC, **_MOVED))
def atlas_build(spark, d):
    return _built(spark, d)[0]


@query("""SELECT event_type AS step, strftime(to_timestamp(s), '%Y-%m-%dT%H:%M:%SZ') AS started_at, strftime(to_timestamp(e), '%Y-%m-%dT%H:%M:%SZ') AS ended_at,
 CASE WHEN e IS NOT NULL AND s IS NOT NULL THEN (greatest(e - s, 0) // 3600) || ':' || lpad(CAST(greatest(e - s, 0) // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(greatest(e - s, 0) % 60 AS VARCHAR), 2, '0') END AS elapsed,
 CAST(count(e) OVER () AS BIGINT) AS done FROM (SELECT event_type, CAST(floor(epoch(min(ts) FILTER (WHERE event_id % 2 = 0))) AS BIGINT) AS s, CAST(floor(epoch(max(ts) FILTER (WHERE event_id % 3 = 0))) AS BIGINT) AS e FROM events GROUP BY 1)""")
def run_progress(spark, d):
    e = T.table(spark, d, "events")
    one = e.filter("event_id % 2 = 0").select(F.col("event_type").alias("step"), F.lit("started").alias("state"), F.col("ts").cast("timestamp").alias("at"))
    two = e.filter("event_id % 3 = 0").select("event_type", F.lit("done"), F.col("ts").cast("timestamp"))
    return Q.progress(one.union(two), 10).drop("eta")
