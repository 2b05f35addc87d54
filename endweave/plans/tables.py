"""Queries on designs, catalogs, atlases, quality tables and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from endweave.functions import genomics as G
from endweave.operators import atlas as B
from endweave.operators import compare as C
from endweave.operators import qc as Q
from endweave.operators import report as P
from endweave.plans import adapters as T
from endweave.plans.core import PLACE, Study
from endweave.plans.registry import query
from endweave.plans.statistics import _BH, _TERMS, _adjusted, _foreground, _terms, r6
from endweave.session import cut

_CUST = {
    "cs": """SELECT 'm' || c_custkey AS sample_id, c_mktsegment AS condition, CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE 'u' || (c_custkey % 9) END AS subject,
 'L' || (c_nationkey % 4) AS lane_id, CAST(c_custkey % 3 AS VARCHAR) AS technical_replicate_id, 'x' || (c_custkey % 200) AS lib FROM customer""",
}


def _samples_of_customers(spark, d):
    c = T.table(spark, d, "customer")
    return c.select(
        F.concat(F.lit("m"), F.col("c_custkey").cast("string")).alias("sample_id"),
        F.col("c_mktsegment").alias("condition"),
        F.when(F.col("c_custkey") % 50 != 0, F.concat(F.lit("u"), (F.col("c_custkey") % 9).cast("string"))).alias("subject"),
        F.concat(F.lit("L"), (F.col("c_nationkey") % 4).cast("string")).alias("lane_id"),
        (F.col("c_custkey") % 3).cast("string").alias("technical_replicate_id"),
        F.concat(F.lit("x"), (F.col("c_custkey") % 200).cast("string")).alias("lib"),
        F.col("c_custkey").alias("ordinal"),
    )


_PAIRS = """SELECT n.condition || '_vs_' || d.condition AS contrast_id, n.condition AS numerator, d.condition AS denominator, CAST(n.n AS BIGINT) AS n_num, CAST(d.n AS BIGINT) AS n_den,
 CASE WHEN least(n.n, d.n) < 3 THEN 'LOW_REPLICATION_N' || least(n.n, d.n) ELSE 'OK' END AS design_status FROM cd n JOIN cd d ON d.o < n.o"""
_CD = "SELECT c_mktsegment AS condition, count(*) AS n, min(c_custkey) AS o FROM customer GROUP BY 1 HAVING count(*) >= 2"


@query(T.sql(_PAIRS, cd=_CD))
def contrast_pairs(spark, d):
    return C.contrast_pairs(_samples_of_customers(spark, d))


@query(T.sql("""SELECT contrast_id, CASE WHEN bool_or(subject = '') THEN 'no_subjects' WHEN bool_and(coalesce(nn = dn, false)) THEN 'complete' WHEN count(*) FILTER (WHERE nn IS NOT NULL AND dn IS NOT NULL) = 0 THEN 'disjoint' ELSE 'incomplete' END AS pairing_status,
 CAST(CASE WHEN bool_or(subject = '') THEN 0 WHEN bool_and(coalesce(nn = dn, false)) THEN count(*) FILTER (WHERE nn IS NOT NULL AND dn IS NOT NULL) ELSE 0 END AS BIGINT) AS n_pairs FROM (
 SELECT * FROM (SELECT contrast_id, coalesce(subject, '') AS subject, count(*) AS nn FROM pr JOIN cs ON cs.condition = pr.numerator GROUP BY 1, 2)
 FULL JOIN (SELECT contrast_id, coalesce(subject, '') AS subject, count(*) AS dn FROM pr JOIN cs ON cs.condition = pr.denominator GROUP BY 1, 2) USING (contrast_id, subject)) GROUP BY 1""", cd=_CD, pr=_PAIRS, **_CUST))
def pairing_state(spark, d):
    samples = _samples_of_customers(spark, d)
    return C.pairing_states(samples, C.contrast_pairs(samples))


@query(T.sql("""SELECT lib AS sample_id, arg_min(condition, struct_pack(l := lane_id, s := sample_id)) AS condition, CAST(count(DISTINCT technical_replicate_id) AS BIGINT) AS technical_replicates, CAST(count(*) AS BIGINT) AS lanes,
 count(DISTINCT condition) > 1 AS inconsistent FROM cs GROUP BY 1""", **_CUST))
def sample_collapse(spark, d):
    rows = _samples_of_customers(spark, d)
    lanes = rows.select(F.col("lib").alias("sample_id"), F.concat_ws("/", "lane_id", "sample_id").alias("lane_id"), "technical_replicate_id", F.lit("g").alias("genome"), "condition", F.lit("u").alias("subject"))
    return Q.collapse_samples(lanes).select("sample_id", "condition", "technical_replicates", "lanes", "inconsistent")


@query(T.sql("SELECT lib AS sample_id, technical_replicate_id, lane_id, CAST(count(*) AS BIGINT) AS rows FROM cs GROUP BY ALL HAVING count(*) > 1", **_CUST))
def duplicated_lanes(spark, d):
    rows = _samples_of_customers(spark, d)
    return Q.duplicated_lanes(rows.select(F.col("lib").alias("sample_id"), "technical_replicate_id", "lane_id"))


def _second_catalog(spark, d):
    """Every third known site, shifted by a few positions, as the other method's catalog."""
    known = T.known_sites(spark, d).filter("strand <> '.'")
    return known.select(F.col("source_id").alias("pas_id"), *PLACE, (F.col("site") + F.col("site") % 11).alias("start"), F.lit("").alias("gene_id"))


def _matches(study: Study):
    a = study.catalog.select("pas_id", *PLACE, "start", "gene_id", F.substring("pas_id", F.lit(5), F.lit(8)).cast("long").alias("ordinal"))
    return cut(C.crosswalk(a, _second_catalog(study.spark, study.d)))


#: Sites of the catalog one after the other: of what is in reach and free, the first by gene, distance and id.
_CROSS = {
    "ca": "SELECT pas_id, chrom, strand, start, gene_id, row_number() OVER (ORDER BY pas_id) AS i FROM cat",
    "cb": "SELECT source_id AS pas_id, chrom, strand, site + site % 11 AS start FROM kn WHERE strand <> '.'",
    "cl": """SELECT i, list({'id': cb.pas_id, 'd': abs(cb.start - ca.start)} ORDER BY abs(cb.start - ca.start), cb.pas_id) AS reach
 FROM ca JOIN cb ON cb.chrom = ca.chrom AND cb.strand = ca.strand AND abs(cb.start - ca.start) <= 24 GROUP BY 1""",
    "gr": """SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS taken, CAST(NULL AS STRUCT(id VARCHAR, d BIGINT)) AS got UNION ALL
 SELECT i, CASE WHEN got IS NULL THEN taken ELSE list_append(taken, got.id) END, got FROM (
 SELECT gr.i + 1 AS i, gr.taken, list_filter(cl.reach, lambda x: NOT list_contains(gr.taken, x.id))[1] AS got
 FROM gr LEFT JOIN cl ON cl.i = gr.i + 1 WHERE gr.i < (SELECT count(*) FROM ca))""",
    "mt": """SELECT ca.pas_id AS a_pas_id, coalesce(got.id, '') AS b_pas_id, chrom, strand, got.d AS distance, gene_id AS a_gene_id, '' AS b_gene_id, CASE WHEN got IS NULL THEN 'a_only' ELSE 'matched' END AS match_class
 FROM ca JOIN gr USING (i) UNION ALL SELECT '', pas_id, chrom, strand, NULL, '', '', 'b_only' FROM cb WHERE pas_id NOT IN (SELECT got.id FROM gr WHERE got IS NOT NULL)""",
    "ef": "SELECT pas_id, (CAST(regexp_extract(pas_id, '[0-9]+') AS BIGINT) * 37 % 41 - 20) / 20.0::DOUBLE AS delta FROM (SELECT pas_id FROM ca UNION ALL SELECT pas_id FROM cb)",
    "mm": """SELECT contrast_id, a_pas_id, b_pas_id, a.delta AS a_delta, b.delta AS b_delta, distance FROM mt JOIN ef a ON a.pas_id = a_pas_id JOIN ef b ON b.pas_id = b_pas_id, (VALUES ('c0'), ('c1')) c(contrast_id)""",
}


def _cross_sql(body: str) -> str:
    return T.sql(body, "cat", "kn", **_CROSS).replace("WITH ", "WITH RECURSIVE ", 1)


@query(_cross_sql("SELECT a_pas_id, b_pas_id, chrom, strand, CAST(distance AS BIGINT) AS distance, a_gene_id, b_gene_id, match_class FROM mt"))
def catalog_crosswalk(spark, d):
    return _matches(Study(spark, d))


def _effects(ids, name: str):
    """Effects that are made up from the number in a site's id."""
    n = F.regexp_extract(name, "[0-9]+", 0).cast("long") * 37 % 41 - 20
    rows = ids.filter(F.col(name) != "").select(F.col(name).alias("pas_id"), (n / F.lit(20.0)).alias("delta"))
    return rows.withColumn("contrast_id", F.explode(F.array(F.lit("c0"), F.lit("c1"))))


@query(_cross_sql("""SELECT contrast_id, a_pas_id, b_pas_id, a_delta, b_delta, CASE WHEN a_delta = 0 OR b_delta = 0 THEN 'zero_effect' WHEN (a_delta > 0) = (b_delta > 0) THEN 'true' ELSE 'false' END AS direction_agreement,
 CAST(distance AS BIGINT) AS distance FROM mm"""))
def effect_concordance(spark, d):
    m = _matches(Study(spark, d))
    return C.concordance(m, _effects(m, "a_pas_id"), _effects(m, "b_pas_id"))


@query(_cross_sql("""SELECT contrast_id, a_pas_id, b_pas_id, a_delta > 0.3 AS a_candidate, b_delta > 0.3 AS b_candidate, a_delta > 0.3 AND b_delta > 0.3 AS agreement FROM mm WHERE a_delta > 0.3 OR b_delta > 0.3"""))
def pcpa_agreement(spark, d):
    m = _matches(Study(spark, d))
    return C.premature_agreement(m, _effects(m, "a_pas_id").filter("delta > 0.3"), _effects(m, "b_pas_id").filter("delta > 0.3"))


_SRC = {
    "sr": """SELECT chrom, strand, site AS pos, source_id, 'GENCODE' AS source, false AS flagged FROM kn WHERE strand <> '.' UNION ALL
 SELECT chrom, strand, site + (site % 13), source_id || 'm', 'MainDB', site % 29 = 0 FROM kn WHERE strand <> '.' AND site % 2 = 0 UNION ALL
 SELECT CASE WHEN site % 31 = 0 THEN 'Z' ELSE chrom END, strand, site * 3 - 5, source_id || 'x', 'MaxDB', false FROM kn WHERE strand <> '.' AND site % 5 = 0""",
    "rj": """SELECT sr.*, CASE WHEN flagged THEN 'internal_priming_flag' WHEN size IS NULL THEN 'unknown_contig' WHEN pos < 0 OR pos >= size THEN 'out_of_bounds' END AS reason FROM sr LEFT JOIN sz USING (chrom)""",
}


def _sources(spark, d):
    k = T.known_sites(spark, d).filter("strand <> '.'")
    s = F.col("site")
    one = k.select(*PLACE, s.alias("pos"), "source_id", F.lit("GENCODE").alias("source"), F.lit(False).alias("flagged"))
    two = k.filter(s % 2 == 0).select(*PLACE, (s + s % 13).alias("pos"), F.concat("source_id", F.lit("m")).alias("source_id"), F.lit("MainDB").alias("source"), (s % 29 == 0).alias("flagged"))
    three = k.filter(s % 5 == 0).select(F.when(s % 31 == 0, "Z").otherwise(F.col("chrom")).alias("chrom"), "strand", (s * 3 - 5).alias("pos"), F.concat("source_id", F.lit("x")).alias("source_id"), F.lit("MaxDB").alias("source"), F.lit(False).alias("flagged"))
    return one.unionByName(two).unionByName(three)


@query(T.sql("SELECT source, coalesce(reason, 'kept') AS reason, CAST(count(*) AS BIGINT) AS records FROM rj GROUP BY ALL", "kn", "sz", **_SRC))
def pas_source_union(spark, d):
    return B.rejected(_sources(spark, d), T.sizes(spark, d)).groupBy("source", F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("records"))


@query(T.sql("""SELECT source, CAST(count(*) AS BIGINT) AS records, CAST(count(DISTINCT (chrom, strand, pos // 20)) AS BIGINT) AS kept, min(first_id) AS smallest FROM (
 SELECT *, first_value(source_id) OVER (PARTITION BY source, chrom, strand, pos // 20 ORDER BY source_id) AS first_id FROM sr) GROUP BY 1""", "kn", "sz", **_SRC))
def pas_dedup_audit(spark, d):
    rows = _sources(spark, d).withColumn("place", F.floor(F.col("pos") / 20))
    kept = B.first_of(rows, ["source", *PLACE, "place"], "source_id")
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("records")).join(kept.groupBy("source").agg(F.count(F.lit(1)).alias("kept"), F.min("source_id").alias("smallest")), "source")


@query(T.sql("""SELECT chrom, strand, coalesce(min(pos) FILTER (WHERE source = 'MainDB'), min(pos) FILTER (WHERE source = 'GENCODE'), min(pos)) AS pos,
 CASE WHEN bool_or(source IN ('MainDB', 'GENCODE')) THEN 'core' ELSE 'rescue' END AS tier,
 CASE WHEN bool_or(source = 'MainDB') AND bool_or(source = 'GENCODE') THEN 'A' WHEN bool_or(source IN ('MainDB', 'GENCODE')) THEN 'B' ELSE 'C' END AS confidence,
 string_agg(DISTINCT source, ';' ORDER BY source) AS sources, string_agg(DISTINCT source_id, ';' ORDER BY source_id) AS source_ids, CAST(count(*) AS BIGINT) AS members FROM (
 SELECT *, sum(new) OVER (PARTITION BY chrom, strand ORDER BY pos RANGE UNBOUNDED PRECEDING) AS cluster FROM (
 SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY chrom, strand ORDER BY pos) > 10 THEN 1 ELSE 0 END AS new FROM rj WHERE reason IS NULL)) GROUP BY chrom, strand, cluster""", "kn", "sz", **_SRC))
def atlas_consensus(spark, d):
    fit = B.rejected(_sources(spark, d), T.sizes(spark, d)).filter("reason is null").drop("reason", "flagged")
    return B.consensus(fit)


@query(T.sql("""SELECT source_id, CASE WHEN n IS NULL THEN 'unmapped' WHEN n > 1 THEN 'multiple' WHEN ts <> strand THEN 'strand_changed' ELSE 'lifted' END AS status,
 CASE WHEN n = 1 AND ts = strand THEN tp END AS to_pos FROM kn LEFT JOIN (SELECT source_id, count(*) AS n, min(to_pos) AS tp, min(to_strand) AS ts FROM (
 SELECT source_id, site + 1000 AS to_pos, CASE WHEN site % 19 = 0 THEN 'x' ELSE strand END AS to_strand FROM kn WHERE site % 7 <> 0 UNION ALL SELECT source_id, site + 2000, strand FROM kn WHERE site % 11 = 0 AND site % 7 <> 0) GROUP BY 1) USING (source_id)""", "kn"))
def liftover_unique(spark, d):
    k = T.known_sites(spark, d)
    s = F.col("site")
    m = k.filter(s % 7 != 0).select("source_id", F.col("chrom").alias("to_chrom"), (s + 1000).alias("to_pos"), F.when(s % 19 == 0, "x").otherwise(F.col("strand")).alias("to_strand"))
    m = m.union(k.filter((s % 11 == 0) & (s % 7 != 0)).select("source_id", "chrom", s + 2000, "strand"))
    return B.lifted(k, m).select("source_id", "status", "to_pos")


@query(T.sql("""SELECT chrom, strand, arg_max(pos, struct_pack(w := weight, d := CASE WHEN strand = '+' THEN pos ELSE -pos END)) AS pos, CAST(sum(weight) AS BIGINT) AS weight, bool_or(rep) AS "repeat" FROM (
 SELECT *, sum(new) OVER (PARTITION BY chrom, strand ORDER BY pos) AS cluster FROM (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY chrom, strand ORDER BY pos) > 24 THEN 1 ELSE 0 END AS new FROM (
 SELECT chrom, strand, pos, sum(count) AS weight, bool_or(pos % 23 = 0) AS rep FROM c1 GROUP BY 1, 2, 3))) GROUP BY chrom, strand, cluster""", "c1"))
def weighted_mode_cluster(spark, d):
    rows = Study(spark, d).c1.select(*PLACE, "pos", "sample_id", F.col("count").alias("weight"), F.lit("l").alias("level"), (F.col("pos") % 23 == 0).alias("repeat"))
    return B.weighted_clusters(rows).drop("levels")


@query(T.sql("""SELECT sample_id, CAST(count(*) AS BIGINT) AS informative, round(count(*) FILTER (WHERE flag & 16 <> 0) / count(*), 6) AS reverse_fraction,
 count(*) < 1000 OR count(*) FILTER (WHERE flag & 16 <> 0) / count(*) >= 0.75 AS passed FROM c0 GROUP BY 1""", "c0"))
def orientation_audit(spark, d):
    al = T.alignments(spark, d).filter(G.is_c0(F.col("flag"), F.col("nh")))
    rev = G.flagged(F.col("flag"), G.REVERSE)
    return Q.orientation(al.groupBy("sample_id").agg(F.count_if(~rev).alias("forward"), F.count_if(rev).alias("reverse"))).select("sample_id", "informative", *r6("reverse_fraction"), "passed")


@query(T.sql("""SELECT sample_id, round(list_sum(vs[1:20]), 4) AS first20, round(list_sum(vs[81:100]), 4) AS last20, round(list_sum(vs[1:20]) / list_sum(vs[81:100]), 6) AS ratio FROM (
 SELECT sample_id, list(v ORDER BY i) AS vs FROM (SELECT 's' || (l_suppkey % 6) AS sample_id, l_orderkey % 100 AS i, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2) GROUP BY 1) WHERE len(vs) = 100"""))
def gene_body_metrics(spark, d):
    li = T.table(spark, d, "lineitem")
    per = li.groupBy(F.concat(F.lit("s"), (F.col("l_suppkey") % 6).cast("string")).alias("sample_id"), (F.col("l_orderkey") % 100).alias("i")).agg(F.sum("l_quantity").alias("v"))
    profiles = per.groupBy("sample_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("values"))
    return Q.gene_body(profiles).select("sample_id", F.round("first20", 4).alias("first20"), F.round("last20", 4).alias("last20"), *r6("ratio"))


@query(T.sql("""SELECT contrast_id, gene_id, round(effect, 6) AS effect, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY contrast_id ORDER BY padj, abs(effect) DESC, gene_id) AS rank FROM bh WHERE padj <= 0.05) WHERE rank <= 25""", "rs", **_BH))
def top_dge(spark, d):
    rows = _adjusted(spark, d).filter("padj <= 0.05").withColumn("padj", F.col("padj"))
    return P.top(rows, ["contrast_id"], ["padj", F.abs("effect").desc(), "gene_id"], 25).select("contrast_id", "gene_id", *r6("effect"), "rank")


@query(T.sql("""SELECT method, contrast_id, gene_id, CAST(rank AS INTEGER) AS rank, premature FROM (SELECT *, row_number() OVER (PARTITION BY method, contrast_id ORDER BY padj, gene_id) AS rank FROM (
 SELECT 'A' AS method, contrast_id, gene_id, padj, CAST(substr(gene_id, 2) AS BIGINT) % 10 = 0 AS premature FROM bh WHERE padj < 0.05 UNION ALL SELECT 'A2', contrast_id, gene_id, padj, CAST(substr(gene_id, 2) AS BIGINT) % 10 = 0 FROM bh WHERE padj <= 0.05
 UNION ALL SELECT 'B', contrast_id, gene_id, pvalue, CAST(substr(gene_id, 2) AS BIGINT) % 10 = 0 FROM bh WHERE pvalue < 0.05)) WHERE rank <= 25""", "rs", **_BH))
def top_apa(spark, d):
    a = _adjusted(spark, d)
    part = lambda name, on, p: a.filter(on).select(F.lit(name).alias("method"), "contrast_id", "gene_id", F.col(p).alias("padj"))
    rows = part("A", "padj < 0.05", "padj").union(part("A2", "padj <= 0.05", "padj")).union(part("B", "pvalue < 0.05", "pvalue"))
    early = T.genes(spark, d).filter(F.substring("gene_id", F.lit(2), F.lit(20)).cast("long") % 10 == 0).select("gene_id", F.lit(True).alias("premature"))
    top = P.top(rows, ["method", "contrast_id"], ["padj", "gene_id"], 25)
    return top.join(early, "gene_id", "left").select("method", "contrast_id", "gene_id", "rank", F.coalesce("premature", F.lit(False)).alias("premature"))


@query(T.sql("""SELECT query, database, term_id, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query, database ORDER BY k DESC, m, term_id) AS rank FROM hh) WHERE rank <= 10""", "rs", **_BH, **_TERMS))
def top_terms(spark, d):
    from endweave.operators import enrich as R

    return P.top(R.ora(_foreground(spark, d), _terms(spark, d)), ["query", "database"], [F.col("k").desc(), "m", "term_id"], 10).select("query", "database", "term_id", "rank")


@query(T.sql("""SELECT s.contrast_id, CAST(s.sig + i.off AS BIGINT) AS significant, CAST(s.sig AS BIGINT) AS found, i.off <> 0 AS stale FROM (SELECT contrast_id, count(*) FILTER (WHERE padj <= 0.05) AS sig FROM bh GROUP BY 1) s
 JOIN (SELECT 'c' || c AS contrast_id, CASE WHEN c = 1 THEN 1 ELSE 0 END AS off FROM range(3) t(c)) i USING (contrast_id)""", "rs", **_BH))
def index_reconciliation(spark, d):
    found = P.contrast_summary(_adjusted(spark, d))
    index = found.select("contrast_id", (F.col("significant_le") + F.when(F.col("contrast_id") == "c1", 1).otherwise(0)).cast("long").alias("significant"))
    return P.reconciled(found, index)


@query("""SELECT event_type AS module, arg_max(CAST(user_id % 7 AS VARCHAR), struct_pack(t := ts, e := event_id)) AS status, max(ts) AS at, CAST(count(*) AS BIGINT) AS events FROM events GROUP BY 1""")
def status_reduce(spark, d):
    e = T.table(spark, d, "events")
    return Q.latest_status(e.select(F.col("event_type").alias("module"), F.col("ts").alias("at"), (F.col("user_id") % 7).cast("string").alias("status"), F.col("event_id").alias("ordinal")))


@query("""SELECT user_id, CAST(floor(min(epoch(ts))) AS BIGINT) AS first_at, CAST(floor(max(epoch(ts))) AS BIGINT) AS last_at, CAST(count(*) AS BIGINT) AS events FROM (
 SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY CAST(floor(epoch(ts)) AS BIGINT)) AS cluster FROM (
 SELECT *, CASE WHEN CAST(floor(epoch(ts)) AS BIGINT) - lag(CAST(floor(epoch(ts)) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY CAST(floor(epoch(ts)) AS BIGINT)) > 3600 THEN 1 ELSE 0 END AS new FROM events)) GROUP BY user_id, cluster""")
def event_gap_clusters(spark, d):
    from endweave.operators.intervals import gap_clusters

    e = T.table(spark, d, "events").select("user_id", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000000).cast("long").alias("at"))
    return gap_clusters(e, ["user_id"], "at", 3600).groupBy("user_id", "cluster").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.count(F.lit(1)).alias("events")).drop("cluster")


@query("""SELECT n_name AS stage, CAST(c AS BIGINT) AS concurrent, CAST(c * th AS BIGINT) AS peak_threads, CAST(c * mem AS BIGINT) AS peak_memory_gb, c * th <= 48 AND c * mem <= 384 AS within FROM (
 SELECT *, greatest(1, least(n_nationkey + 1, 48 // th, 384 // mem)) AS c FROM (SELECT *, n_nationkey % 7 * 10 + 1 AS th, n_nationkey % 5 * 20 + 4 AS mem FROM nation))""")
def resource_plan(spark, d):
    n = F.col("n_nationkey")
    return Q.resource_plan(T.table(spark, d, "nation").select(F.col("n_name").alias("stage"), (n + 1).alias("jobs"), (n % 7 * 10 + 1).alias("threads"), (n % 5 * 20 + 4).alias("memory_gb")), 48, 384)


@query("""SELECT s_name AS name, format('track type=bigWig name="{}" description="{}" bigDataUrl=https://tracks/{} color=0,0,{} visibility=full autoScale=on negateValues={} priority={}', s_name, s_name, s_suppkey, s_suppkey % 256, CASE WHEN s_suppkey % 2 = 1 THEN 'on' ELSE 'off' END, s_suppkey) AS line, true AS valid FROM supplier""")
def ucsc_descriptors(spark, d):
    s = F.col("s_suppkey")
    tracks = T.table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.concat(F.lit("https://tracks/"), s.cast("string")).alias("url"), F.when(s % 2 == 1, "-").otherwise("+").alias("strand"), F.concat(F.lit("0,0,"), (s % 256).cast("string")).alias("color"), s.alias("priority"))
    return Q.track_lines(tracks)


@query("""SELECT p_partkey, CAST(list_sum(list_transform(range(1, length(p_name) + 1), lambda i: ascii(substr(p_name, CAST(i AS BIGINT), 1)) * i)) % 2147483647 AS BIGINT) AS seed, regexp_replace(p_name || '.' || (p_size % 9), '[.][0-9]+$', '') AS unversioned FROM part""")
def contrast_seeds(spark, d):
    p = T.table(spark, d, "part")
    versioned = F.concat_ws(".", "p_name", (F.col("p_size") % 9).cast("string"))
    return p.select("p_partkey", G.checksum_seed(F.col("p_name")).alias("seed"), G.unversioned(versioned).alias("unversioned"))


@query("""SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN NULL WHEN event_id % 4 = 2 THEN NULL ELSE CAST(event_id AS DOUBLE) END AS number FROM events""")
def number_parsing(spark, d):
    e = T.table(spark, d, "events")
    n = F.col("event_id") % 4
    text = F.when(n == 0, "NA").when(n == 1, "").when(n == 2, "NaN").otherwise(F.col("event_id").cast("string"))
    return e.select("event_id", G.finite(text).alias("number"))


@query(T.sql("""SELECT least(a, b) AS sample_a, greatest(a, b) AS sample_b, round(sqrt(d2), 6) AS distance FROM (SELECT x.sample_id AS a, y.sample_id AS b, sum(pow(x.v - y.v, 2)) AS d2 FROM vv x JOIN vv y ON x.gene_id = y.gene_id AND x.sample_id < y.sample_id GROUP BY 1, 2)""",
 "ct", "cat", "smp", vv="""SELECT gene_id, smp.sample_id, log2(coalesce(c, 0) + 1) AS v FROM (SELECT DISTINCT gene_id FROM cat WHERE assignment_status = 'unique') CROSS JOIN smp LEFT JOIN (
 SELECT gene_id, sample_id, sum(count) AS c FROM ct JOIN cat USING (pas_id) WHERE assignment_status = 'unique' GROUP BY 1, 2) g USING (gene_id, sample_id)"""))
def sample_distance(spark, d):
    from endweave.operators.ends import gene_counts
    from endweave.operators.models import sample_distances

    study = Study(spark, d)
    counts = gene_counts(study.catalog, study.counts).select("gene_id", "sample_id", F.log2(F.col("count") + 1).alias("value"))
    return sample_distances(counts).select("sample_a", "sample_b", *r6("distance"))


@query()
def sample_components(spark, d):
    from endweave.operators.ends import gene_counts
    from endweave.operators.models import principal_components

    study = Study(spark, d)
    counts = gene_counts(study.catalog, study.counts).select("gene_id", "sample_id", F.log2(F.col("count") + 1).alias("value"))
    return principal_components(counts)


def _contrast_design(spark, d) -> str:
    """The resolved design of the contrast of B with A: paired, as its subjects are complete."""
    from endweave.operators.compare import pairing_states
    from endweave.operators.design import resolved

    contrast = spark.createDataFrame([("B_vs_A", "B", "A")], "contrast_id string, numerator string, denominator string")
    state = pairing_states(T.samples(spark, d), contrast).first()
    return resolved("auto", state["pairing_status"], state["n_pairs"])[0]


@query()
def nb_wald(spark, d):
    from endweave.operators.ends import gene_counts
    from endweave.operators.models import negative_binomial_tests

    study = Study(spark, d)
    return negative_binomial_tests(gene_counts(study.catalog, study.counts), T.samples(spark, d), "A", "B", design=_contrast_design(spark, d))


@query()
def exon_usage_lrt(spark, d):
    from endweave.operators.models import usage_tests
    from endweave.plans.statistics import _testable

    study = Study(spark, d)
    return usage_tests(study.counts.join(_testable(study).select("pas_id", "gene_id"), "pas_id"), T.samples(spark, d), "A", "B", design=_contrast_design(spark, d))


@query()
def dm_usage(spark, d):
    from endweave.operators.models import dirichlet_tests
    from endweave.plans.statistics import _testable

    study = Study(spark, d)
    return dirichlet_tests(study.counts.join(_testable(study).select("pas_id", "gene_id"), "pas_id"), T.samples(spark, d), "A", "B", design=_contrast_design(spark, d))
