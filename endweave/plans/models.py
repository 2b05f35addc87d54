"""Queries on gene models, read counting, coverage and tracks."""

from __future__ import annotations

from pyspark.sql import functions as F

from endweave.operators import annotation as N
from endweave.operators import expression as X
from endweave.plans import adapters as T
from endweave.plans.core import PLACE, Study
from endweave.plans.registry import query
from endweave.session import cut

EXT, BUFFER = 600, 60

_UNION = """SELECT gene_id, chrom, strand, min(start) AS start, max("end") AS "end" FROM (
 SELECT *, sum(new) OVER (PARTITION BY gene_id, chrom, strand ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM (
 SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY gene_id, chrom, strand ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM ex))
 GROUP BY gene_id, chrom, strand, island"""

_CLIP = {
    "tss": "SELECT gene_id, chrom, strand, CASE WHEN strand = '+' THEN min(start) ELSE max(\"end\") - 1 END AS tss FROM ex GROUP BY gene_id, transcript_id, chrom, strand",
    "bar": f"""SELECT chrom, strand, gene_id, start, "end", 'other_gene_body' AS reason FROM gn UNION ALL
 SELECT chrom, strand, gene_id, lo, hi, 'tss_buffer' FROM (SELECT *, CASE WHEN strand = '+' THEN greatest(0, tss - {BUFFER} + 1) ELSE tss + 1 END AS lo,
 CASE WHEN strand = '+' THEN tss ELSE least(2000000, tss + {BUFFER}) END AS hi FROM tss) WHERE lo < hi""",
    "req": f"""SELECT *, CASE WHEN "end" - start = {EXT} THEN 'full_cap' ELSE 'chromosome_edge' END AS reason FROM (
 SELECT gene_id, chrom, strand, a AS anchor, CASE WHEN strand = '+' THEN a ELSE greatest(0, a - {EXT}) END AS start, CASE WHEN strand = '+' THEN least(2000000, a + {EXT}) ELSE a END AS "end"
 FROM (SELECT gene_id, chrom, strand, CASE WHEN strand = '+' THEN "end" ELSE start END AS a FROM gn))""",
    "n1": """SELECT req.gene_id, min(struct_pack(at := CASE WHEN req.strand = '+' THEN greatest(req.start, bar.start) ELSE -least(req."end", bar."end") END, who := bar.gene_id, why := bar.reason)) AS b
 FROM req JOIN bar ON bar.chrom = req.chrom AND bar.strand = req.strand AND bar.gene_id <> req.gene_id AND bar.start < req."end" AND req.start < bar."end" AND req.start < req."end" GROUP BY ALL""",
    "e1": """SELECT gene_id, chrom, strand, anchor, CASE WHEN b IS NOT NULL AND strand = '-' THEN least("end", -b.at) ELSE start END AS start,
 CASE WHEN b IS NOT NULL AND strand = '+' THEN greatest(start, b.at) ELSE "end" END AS "end", coalesce(b.why, reason) AS reason, coalesce(b.who, '') AS limiting_gene FROM req LEFT JOIN n1 USING (gene_id)""",
    "n2": """SELECT e.gene_id, min(struct_pack(at := CASE WHEN e.strand = '+' THEN greatest(e.start, o.start) ELSE -least(e."end", o."end") END, who := o.gene_id)) AS b
 FROM e1 e JOIN e1 o ON o.chrom = e.chrom AND o.strand = e.strand AND o.gene_id <> e.gene_id AND o.start < e."end" AND e.start < o."end" AND e.start < e."end" AND o.start < o."end" GROUP BY ALL""",
    "e2": """SELECT gene_id, chrom, strand, anchor, CASE WHEN b IS NOT NULL AND strand = '-' THEN least("end", -b.at) ELSE start END AS start,
 CASE WHEN b IS NOT NULL AND strand = '+' THEN greatest(start, b.at) ELSE "end" END AS "end", CASE WHEN b IS NOT NULL THEN 'extension_conflict' ELSE reason END AS reason, coalesce(b.who, limiting_gene) AS limiting_gene FROM e1 LEFT JOIN n2 USING (gene_id)""",
}


def _starts(spark, d):
    ex = T.exons(spark, d)
    per = ex.groupBy("gene_id", "transcript_id", *PLACE).agg(F.min("start").alias("a"), F.max("end").alias("b"))
    return per.select("gene_id", *PLACE, F.when(F.col("strand") == "+", F.col("a")).otherwise(F.col("b") - 1).alias("tss"))


def _first_clip(spark, d):
    genes, sizes = T.genes(spark, d), T.sizes(spark, d)
    wanted = N.requested(genes, T.exons(spark, d), sizes, EXT)
    return N.clip(wanted, N.barriers(genes, _starts(spark, d), sizes, BUFFER), T.GENE_BIN)


@query(T.sql(_UNION, "ex"))
def exon_union(spark, d):
    return N.exon_union(T.exons(spark, d))


@query(T.sql('SELECT gene_id, chrom, strand, anchor, start, "end", reason, limiting_gene FROM e1', "ex", "gn", **_CLIP))
def extension_barrier_clip(spark, d):
    return _first_clip(spark, d)


@query(T.sql('SELECT gene_id, chrom, strand, anchor, start, "end", reason, limiting_gene FROM e2', "ex", "gn", **_CLIP))
def extension_conflict_clip(spark, d):
    return N.clip_conflicts(_first_clip(spark, d), T.GENE_BIN)


@query(T.sql("""SELECT e2.gene_id, string_agg(DISTINCT gn.gene_id, ';' ORDER BY gn.gene_id) AS overlaps FROM e2 JOIN gn ON gn.chrom = e2.chrom AND gn.strand <> e2.strand
 AND gn.start < e2."end" AND e2.start < gn."end" AND e2.start < e2."end" GROUP BY 1""", "ex", "gn", **_CLIP))
def extension_opposite_overlaps(spark, d):
    return N.opposite_overlaps(N.clip_conflicts(_first_clip(spark, d), T.GENE_BIN), T.genes(spark, d), T.GENE_BIN)


@query(T.sql("""SELECT chrom, min(start) AS start, max("end") AS "end", gene_id || '|' || transcript_id AS name, strand, CAST(count(*) AS BIGINT) AS block_count,
 string_agg(CAST("end" - start AS VARCHAR), ',' ORDER BY start) AS block_sizes, string_agg(CAST(start - s0 AS VARCHAR), ',' ORDER BY start) AS block_starts
 FROM (SELECT *, min(start) OVER (PARTITION BY transcript_id) AS s0 FROM ex) GROUP BY chrom, strand, gene_id, transcript_id""", "ex"))
def transcript_bed12(spark, d):
    return N.bed12(T.exons(spark, d))


def _blocks(spark, d):
    from endweave.functions import genomics as G

    al = T.alignments(spark, d).filter(G.is_c0(F.col("flag"), F.col("nh")))
    return al.select("sample_id", F.col("read_name").alias("read"), "chrom", G.transcript_strand(F.col("flag")).alias("strand"), F.col("ref_start").alias("start"), F.col("ref_end").alias("end"))


@query(T.sql(f"""SELECT sample_id, g AS gene_id, CAST(count(*) AS BIGINT) AS count FROM (
 SELECT sample_id, CASE WHEN n = 1 THEN g WHEN n > 1 THEN '__ambiguous' ELSE '__no_feature' END AS g FROM (SELECT DISTINCT sample_id, rid FROM rd) LEFT JOIN (
 SELECT rid, count(DISTINCT gene_id) AS n, min(gene_id) AS g FROM rd JOIN un ON un.chrom = rd.chrom AND un.strand = rd.strand AND un.start < rd.ref_end AND rd.ref_start < un."end" GROUP BY 1) USING (rid))
 GROUP BY 1, 2""", "c0", "ex", rd="SELECT * FROM c0", un=_UNION))
def read_gene_counts(spark, d):
    return N.read_gene_counts(_blocks(spark, d), N.exon_union(T.exons(spark, d)), T.GENE_BIN)


@query(T.sql("""SELECT sample_id, chrom, strand, x AS start, nx AS "end", CAST(depth AS BIGINT) AS depth FROM (
 SELECT *, sum(dd) OVER (PARTITION BY sample_id, chrom, strand ORDER BY x ROWS UNBOUNDED PRECEDING) AS depth, lead(x) OVER (PARTITION BY sample_id, chrom, strand ORDER BY x) AS nx FROM (
 SELECT sample_id, chrom, strand, x, sum(dd) AS dd FROM (SELECT sample_id, chrom, strand, ref_start AS x, 1 AS dd FROM c0 UNION ALL SELECT sample_id, chrom, strand, ref_end, -1 FROM c0) GROUP BY ALL HAVING sum(dd) <> 0))
 WHERE depth > 0""", "c0"))
def strand_coverage(spark, d):
    return N.strand_coverage(_blocks(spark, d))


_SF = {
    "gc": "SELECT gene_id, sample_id, sum(count) AS count FROM ct JOIN cat USING (pas_id) WHERE assignment_status = 'unique' GROUP BY ALL",
    "ml": "SELECT gene_id, sum(CASE WHEN count > 0 THEN ln(count) ELSE 0 END) / 6.0 AS mean_log FROM gc GROUP BY 1 HAVING max(count) > 0",
    "md": "SELECT sample_id, median(CASE WHEN count > 0 THEN exp(ln(count) - mean_log) END) AS med FROM gc JOIN ml USING (gene_id) GROUP BY 1",
    "sf": """SELECT sample_id, total, exp(ln(med) - avg(ln(med)) OVER ()) AS size_factor, exp(avg(CASE WHEN total > 0 THEN ln(total) END) OVER ()) AS geometric_mean
 FROM (SELECT sample_id, CAST(sum(count) AS BIGINT) AS total FROM gc GROUP BY 1) LEFT JOIN md USING (sample_id)""",
}


def _factors(study: Study):
    from endweave.operators.ends import gene_counts

    # Written once: factors read counts of genes several times.
    return X.size_factors(cut(gene_counts(study.catalog, study.counts)))


@query(T.sql("""SELECT sample_id, total, round(size_factor, 6) AS size_factor, round(geometric_mean, 6) AS geometric_mean, round(1.0 / size_factor, 6) AS deseq2_scale,
 round(1e6 / (size_factor * geometric_mean), 6) AS robust_scale FROM sf""", "ct", "cat", **_SF))
def size_factors(spark, d):
    r = lambda c: F.round(c, 6).alias(c)
    return _factors(Study(spark, d)).select("sample_id", "total", r("size_factor"), r("geometric_mean"), r("deseq2_scale"), r("robust_scale"))


@query(T.sql("""SELECT sample_id, CASE chrom WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS ordinal, chrom, strand, pos AS start, pos + 1 AS "end",
 round(count * (1e6 / total) * CASE WHEN strand = '-' THEN -1.0 ELSE 1.0 END, 6) AS value FROM c2 JOIN tot USING (sample_id)""", "c2", "tot"))
def bedgraph_signal(spark, d):
    study = Study(spark, d)
    scales = study.c2.groupBy("sample_id").agg((F.lit(1e6) / F.sum("count")).alias("scale"))
    order = spark.createDataFrame([("A", 1, T.CHROM_SIZE), ("N", 2, T.CHROM_SIZE), ("R", 3, T.CHROM_SIZE)], "chrom string, ordinal int, size long")
    return N.signal_bedgraph(study.c2, scales, order).withColumn("value", F.round("value", 6))


@query(T.sql("""SELECT sample_id, family, denominator, 1.0::DOUBLE AS raw, round(CASE WHEN denominator > 0 THEN 1e6 / denominator END, 6) AS cpm, round(1.0 / size_factor, 6) AS deseq2_scale,
 round(1e6 / (size_factor * geometric_mean), 6) AS robust_scale FROM (
 SELECT sample_id, unnest(['C1', 'C2', 'C2R', 'active_PAS']) AS family, unnest([c1n, c2n, c1n, c3n]) AS denominator FROM (
 SELECT sample_id, CAST(sum(count) AS BIGINT) AS c1n FROM c1 GROUP BY 1) JOIN (SELECT sample_id, CAST(sum(count) AS BIGINT) AS c2n FROM c2 GROUP BY 1) USING (sample_id)
 JOIN (SELECT sample_id, CAST(sum(count) AS BIGINT) AS c3n FROM ct GROUP BY 1) USING (sample_id)) LEFT JOIN sf USING (sample_id)""", "c1", "c2", "ct", "cat", **_SF))
def track_scales(spark, d):
    study = Study(spark, d)
    total = lambda df, name, of: df.groupBy("sample_id").agg(F.sum("count").cast("long").alias("total")).select("sample_id", F.lit(name).alias("family"), "total", F.lit(of).alias("denominator_of"))
    families = total(study.c1, "C1", "C1").union(total(study.c2, "C2", "C2")).union(total(study.dropped, "C2R", "C1")).union(total(study.counts, "active_PAS", "active_PAS"))
    out = N.track_scales(families, _factors(study))
    return out.select("sample_id", "family", "denominator", "raw", F.round("cpm", 6).alias("cpm"), F.round("deseq2_scale", 6).alias("deseq2_scale"), F.round("robust_scale", 6).alias("robust_scale"))
