"""Queries on ends, sites, intervals, gene assignment and sequences."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from endweave.functions import genomics as G
from endweave.operators import assign as A
from endweave.operators import ends as E
from endweave.operators import intervals as I
from endweave.plans import adapters as T
from endweave.plans.registry import query
from endweave.session import cut, written

PLACE = ["chrom", "strand"]


class Study:
    """The tables that many queries start from; each is worked out once, narrow ones are written."""

    def __init__(self, spark, d, masks=None):
        """masks: gives (chrom, strand, pos, masked) of places; without, masks are made up from positions."""
        self.spark, self.d, self.masks = spark, d, masks

    @cached_property
    def ends(self) -> DataFrame:
        return written(E.exact_ends(T.alignments(self.spark, self.d)))

    @cached_property
    def c1(self) -> DataFrame:
        rows = self.ends.filter("unclipped > 0").select("sample_id", *PLACE, "pos", F.col("unclipped").alias("count"))
        if self.masks is not None:
            return written(rows.join(self.masks(rows), [*PLACE, "pos"]).select("sample_id", *PLACE, "pos", "count", "masked"))
        return rows.withColumn("masked", F.col("pos") % 17 == 0)

    @cached_property
    def stranded_known(self) -> DataFrame:
        both = F.when(F.col("strand") == ".", F.array(F.lit("+"), F.lit("-"))).otherwise(F.array("strand"))
        return T.known_sites(self.spark, self.d).select("chrom", F.explode(both).alias("strand"), "site", "source_id")

    def _near_known(self, rows: DataFrame) -> DataFrame:
        spans = self.stranded_known.select(*PLACE, (F.col("site") - 9).alias("lo"), (F.col("site") + 11).alias("hi"))
        return I.points_in(rows, spans, PLACE, "pos", "lo", "hi", "left_semi", I.FINE)

    @cached_property
    def rescued(self) -> DataFrame:
        """Positions of C1 within the rescue interval of a known site."""
        return self._near_known(self.c1.select(*PLACE, "pos").distinct())

    @cached_property
    def routed(self) -> DataFrame:
        hit = self.rescued.withColumn("rescued", F.lit(True))
        ends = self.c1.join(hit, [*PLACE, "pos"], "left").withColumn("rescued", F.coalesce("rescued", F.lit(False)))
        return E.route_masked(ends, F.col("masked"), F.col("rescued"))

    @cached_property
    def c2(self) -> DataFrame:
        """As ``routed`` has it: only ends that are masked need a known site, and are written again."""
        rows = ["sample_id", *PLACE, "pos", "count"]
        return self.c1.filter("not masked").select(*rows).union(written(self._near_known(self.c1.filter("masked").select(*rows))))

    @cached_property
    def dropped(self) -> DataFrame:
        """C2R as ``routed`` has it, of masked ends alone."""
        rows = self.c1.filter("coalesce(masked, true)").select("sample_id", *PLACE, "pos", "count")
        return rows.join(self._near_known(rows.select(*PLACE, "pos").distinct()), [*PLACE, "pos"], "left_anti").select(*rows.columns)

    @cached_property
    def pooled(self) -> DataFrame:
        """In millionths, see ``ends.pooled_signal``; so is the threshold."""
        return written(E.pooled_signal(self.c2))

    @cached_property
    def totals(self) -> DataFrame:
        return cut(E.sample_totals(self.c2))

    @cached_property
    def signal(self) -> DataFrame:
        """As ``pooled``, not summed by place yet: what a row of C2 adds."""
        return E.scaled_signal(self.c2, self.totals)

    @cached_property
    def threshold(self):
        """Five reads of the mean sample, per million."""
        total = self.totals.agg(F.sum("total")).first()[0] or 1
        return E.millionths(F.lit(5) * F.lit(6e6) / F.lit(int(total)))

    @cached_property
    def components(self) -> DataFrame:
        return I.window_components(self.pooled.withColumnRenamed("cpm", "value"), PLACE, 30, self.threshold)

    @cached_property
    def sites(self) -> DataFrame:
        return written(E.numbered(written(E.discover_sites(self.signal, T.sizes(self.spark, self.d), self.threshold))))

    @cached_property
    def counts(self) -> DataFrame:
        return cut(E.count_sites(self.sites, self.c2, T.samples(self.spark, self.d)))

    @cached_property
    def catalog(self) -> DataFrame:
        return cut(A.assign_genes(self.sites, T.genes(self.spark, self.d), T.exons(self.spark, self.d), T.EXTENSION, T.GENE_BIN))

    @cached_property
    def annotated(self) -> DataFrame:
        ex = T.exons(self.spark, self.d)
        cds, utr = ex.filter("kind = 'CDS'"), ex.filter("kind <> 'CDS' and start % 3 = 0")
        return A.annotate_sites(self.sites, T.genes(self.spark, self.d), ex, cds, utr, T.GENE_BIN)


@query(T.sql("SELECT sample_id, chrom, strand, pos, flag FROM c0", "c0"))
def c0_filter(spark, d):
    al = T.alignments(spark, d)
    f = F.col("flag")
    return al.filter(G.is_c0(f, F.col("nh"))).select(
        "sample_id", "chrom", G.transcript_strand(f).alias("strand"), G.transcript_end(f, F.col("ref_start"), F.col("ref_end")).alias("pos"), "flag"
    )


@query(T.sql("""SELECT CASE WHEN flag & 4 <> 0 THEN 'unmapped' WHEN flag & 256 <> 0 THEN 'secondary' WHEN flag & 2048 <> 0 THEN 'supplementary'
 WHEN coalesce(nh, 0) <> 1 THEN 'multimapping_or_missing_NH' ELSE 'eligible_primary' END AS class, clip AS clipped, soft AS soft_clipped,
 CAST(count(*) AS BIGINT) AS reads FROM al GROUP BY ALL""", "al"))
def mapping_classes(spark, d):
    f = F.col("flag")
    return (
        T.alignments(spark, d)
        .groupBy(G.mapping_class(f, F.col("nh")).alias("class"), G.end_clipped(f, F.col("cigar")).alias("clipped"), G.end_clipped(f, F.col("cigar"), hard=False).alias("soft_clipped"))
        .agg(F.count(F.lit(1)).alias("reads"))
    )


@query(T.sql("""SELECT strand_of AS strand, CAST(count(*) AS BIGINT) AS reads FROM (
 SELECT unnest([CASE WHEN flag & 16 <> 0 THEN '+' ELSE '-' END]) AS strand_of FROM al) GROUP BY ALL""", "al"))
def strand_selection(spark, d):
    al = T.alignments(spark, d).withColumn("layout", F.lit("SE"))
    parts = [al.filter(G.strand_selected(F.col("flag"), F.col("layout"), s) & G.defines_end(F.col("flag"), F.col("layout"))).agg(F.count(F.lit(1)).alias("reads")).select(F.lit(s).alias("strand"), "reads") for s in "+-"]
    return parts[0].union(parts[1])


@query(T.sql("SELECT * FROM en", "en"))
def exact_ends(spark, d):
    study = Study(spark, d)
    return study.ends


@query(T.sql("""SELECT sample_id, c0, c1, c1s, c2, c2r, rescued, round(100.0 * c1 / c0, 2) AS c1_pct, round(100.0 * c2 / c0, 2) AS c2_pct,
 c0 = c1 + c1s AND c1 = c2 + c2r AS reconciled FROM (
 SELECT sample_id, CAST(sum(unclipped + clipped) AS BIGINT) AS c0, CAST(sum(unclipped) AS BIGINT) AS c1, CAST(sum(clipped) AS BIGINT) AS c1s FROM en GROUP BY 1)
 JOIN (SELECT sample_id, CAST(coalesce(sum(count) FILTER (WHERE NOT masked OR rescued), 0) AS BIGINT) AS c2,
 CAST(coalesce(sum(count) FILTER (WHERE masked AND NOT rescued), 0) AS BIGINT) AS c2r,
 CAST(coalesce(sum(count) FILTER (WHERE masked AND rescued), 0) AS BIGINT) AS rescued FROM c2r GROUP BY 1) USING (sample_id)""", "en", "c2r"))
def end_audit_funnel(spark, d):
    study = Study(spark, d)
    from endweave.operators.qc import end_audit

    return end_audit(study.ends, study.routed)


@query(T.sql("SELECT chrom, strand, pos, CAST(cpm AS DOUBLE) AS cpm FROM pl", "pl"))
def pooled_cpm(spark, d):
    study = Study(spark, d)
    return study.pooled.select(*PLACE, "pos", (F.col("cpm") / F.lit(1e6)).alias("cpm"))


@query(T.sql('SELECT chrom, strand, start, "end" FROM cp', "cp"))
def window_components(spark, d):
    study = Study(spark, d)
    return study.components


@query(T.sql("""SELECT chrom, strand, min(start) AS start, max("end") AS "end", CAST(count(*) AS BIGINT) AS members FROM (
 SELECT *, sum(new) OVER (PARTITION BY chrom, strand ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM (
 SELECT *, CASE WHEN start < max("end") OVER (PARTITION BY chrom, strand ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new
 FROM (SELECT chrom, strand, pos AS start, pos + 8 AS "end" FROM c1))) GROUP BY chrom, strand, island""", "c1"))
def interval_merge(spark, d):
    study = Study(spark, d)
    return I.merge(study.c1.select(*PLACE, F.col("pos").alias("start"), (F.col("pos") + 8).alias("end")), PLACE)


@query(T.sql('SELECT chrom, strand, summit, start, "end" FROM r1', "r1"))
def recenter_sites(spark, d):
    study = Study(spark, d)
    return E.recenter(study.components, study.pooled, T.sizes(spark, d), 30)


@query(T.sql('SELECT pas_id, chrom, strand, summit, start, "end", "end" - start AS actual_width FROM st', "st"))
def active_pas(spark, d):
    study = Study(spark, d)
    return study.sites.select("pas_id", *PLACE, "summit", "start", "end", (F.col("end") - F.col("start")).alias("actual_width"))


@query(T.sql("SELECT pas_id, sample_id, count FROM ct", "ct"))
def site_counts_long(spark, d):
    study = Study(spark, d)
    return study.counts


@query(T.sql("""SELECT pas_id, CAST(sum(count) FILTER (WHERE sample_id = 's0') AS BIGINT) AS s0, CAST(sum(count) FILTER (WHERE sample_id = 's1') AS BIGINT) AS s1,
 CAST(sum(count) FILTER (WHERE sample_id = 's2') AS BIGINT) AS s2, CAST(sum(count) FILTER (WHERE sample_id = 's3') AS BIGINT) AS s3,
 CAST(sum(count) FILTER (WHERE sample_id = 's4') AS BIGINT) AS s4, CAST(sum(count) FILTER (WHERE sample_id = 's5') AS BIGINT) AS s5 FROM ct GROUP BY 1""", "ct"))
def site_counts_wide(spark, d):
    study = Study(spark, d)
    return study.counts.groupBy("pas_id").pivot("sample_id", [f"s{i}" for i in range(6)]).agg(F.sum("count"))


@query(T.sql("SELECT gene_id, sample_id, CAST(sum(count) AS BIGINT) AS count FROM ct JOIN cat USING (pas_id) WHERE assignment_status = 'unique' GROUP BY ALL", "ct", "cat"))
def gene_counts(spark, d):
    study = Study(spark, d)
    return E.gene_counts(study.catalog, study.counts)


@query(T.sql("SELECT sample_id, chrom, strand, pos, count FROM c2r WHERE rescued", "c2r"))
def rescue_semi_join(spark, d):
    study = Study(spark, d)
    return study.c1.join(study.rescued, [*PLACE, "pos"], "left_semi").select("sample_id", *PLACE, "pos", "count")


@query(T.sql("""SELECT c.chrom AS chrom, c.strand AS strand, pos, least(pos - b.site, a.site - pos) AS distance FROM (SELECT DISTINCT chrom, strand, pos FROM c1) c
 ASOF LEFT JOIN (SELECT DISTINCT chrom, strand, site FROM k2) b ON c.chrom = b.chrom AND c.strand = b.strand AND c.pos >= b.site
 ASOF LEFT JOIN (SELECT DISTINCT chrom, strand, site FROM k2) a ON c.chrom = a.chrom AND c.strand = a.strand AND c.pos <= a.site""", "c1", "k2"))
def nearest_known_distance(spark, d):
    study = Study(spark, d)
    return I.nearest_distance(study.c1.select(*PLACE, "pos").distinct(), study.stranded_known, PLACE)


def _clusters(gap: int) -> str:
    return T.sql(f"""SELECT chrom, strand, min(pos) AS first_pos, max(pos) AS last_pos, CAST(sum(n) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS positions FROM (
 SELECT *, sum(new) OVER (PARTITION BY chrom, strand ORDER BY pos) AS cluster FROM (
 SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY chrom, strand ORDER BY pos) > {gap} THEN 1 ELSE 0 END AS new
 FROM (SELECT chrom, strand, pos, sum(count) AS n FROM c1 GROUP BY ALL))) GROUP BY chrom, strand, cluster""", "c1")


def _clustered(spark, d, gap: int):
    study = Study(spark, d)
    places = study.c1.groupBy(*PLACE, "pos").agg(F.sum("count").alias("n"))
    return I.gap_clusters(places, PLACE, "pos", gap).groupBy(*PLACE, "cluster").agg(
        F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("positions")
    ).drop("cluster")


@query(_clusters(24))
def gap_clusters_24(spark, d):
    return _clustered(spark, d, 24)


@query(_clusters(10))
def gap_clusters_10(spark, d):
    return _clustered(spark, d, 10)


@query(T.sql("""SELECT pas_id, chrom, strand, summit, gene_id, feature_class, assignment_status FROM cat""", "cat"))
def gene_assignment(spark, d):
    study = Study(spark, d)
    return study.catalog.select("pas_id", *PLACE, "summit", "gene_id", "feature_class", "assignment_status")


_CODING = {
    "cds": "SELECT gene_id, start, \"end\" FROM ex WHERE kind = 'CDS'",
    "utr": "SELECT gene_id, start, \"end\" FROM ex WHERE kind <> 'CDS' AND start % 3 = 0",
    "bh": """SELECT pas_id, summit, gn.* FROM st JOIN gn ON gn.chrom = st.chrom AND gn.strand = st.strand AND summit >= gn.start AND summit < gn."end" """,
    "an": """SELECT pas_id, gene_id, CASE
 WHEN EXISTS (SELECT 1 FROM utr WHERE utr.gene_id = bh.gene_id AND summit >= utr.start AND summit < utr."end") THEN
  CASE WHEN CASE WHEN strand = '+' THEN summit >= (SELECT max("end") FROM cds WHERE cds.gene_id = bh.gene_id) ELSE summit < (SELECT min(start) FROM cds WHERE cds.gene_id = bh.gene_id) END
  THEN 'terminal_3UTR' ELSE 'internal_UTR' END
 WHEN EXISTS (SELECT 1 FROM cds WHERE cds.gene_id = bh.gene_id AND summit >= cds.start AND summit < cds."end") THEN 'internal_exon_CDS'
 WHEN EXISTS (SELECT 1 FROM ex WHERE ex.gene_id = bh.gene_id AND summit >= ex.start AND summit < ex."end") THEN
  CASE WHEN EXISTS (SELECT 1 FROM ex WHERE ex.gene_id = bh.gene_id AND summit >= ex.start AND summit < ex."end"
   AND CASE WHEN bh.strand = '+' THEN ex."end" = bh."end" ELSE ex.start = bh.start END) THEN 'terminal_exon' ELSE 'internal_exon' END
 ELSE 'intron' END AS feature FROM bh""",
    "ann": """SELECT st.*, coalesce(CASE WHEN n = 1 THEN g END, '') AS gene_id, CASE WHEN n = 1 THEN feature WHEN n > 1 THEN 'ambiguous_multi_gene' ELSE 'intergenic' END AS feature_class
 FROM st LEFT JOIN (SELECT pas_id, count(*) AS n, min(feature) AS feature, min(gene_id) AS g FROM an GROUP BY 1) USING (pas_id)""",
}


@query(T.sql("SELECT pas_id, gene_id, feature_class FROM ann", "st", "gn", "ex", **_CODING))
def gene_feature_annotation(spark, d):
    study = Study(spark, d)
    return study.annotated.select("pas_id", "gene_id", "feature_class")


@query(T.sql("""SELECT pas_id, ann.gene_id, CASE feature_class WHEN 'intron' THEN 'composite_or_skipped_terminal_exon' WHEN 'internal_exon_CDS' THEN 'truncated_coding_sequence' ELSE 'truncated_transcript' END AS consequence
 FROM ann JOIN gn USING (gene_id) WHERE feature_class IN ('intron', 'internal_exon', 'internal_exon_CDS', 'internal_UTR')
 AND CASE WHEN ann.strand = '+' THEN summit < gn."end" - 1 ELSE summit > gn.start END""", "st", "gn", "ex", **_CODING))
def pcpa_upstream(spark, d):
    study = Study(spark, d)
    return A.upstream_candidates(study.annotated, T.genes(spark, d)).select("pas_id", "gene_id", "consequence")


@query(T.sql("""SELECT pas_id, gene_id, feature_class FROM cat WHERE assignment_status = 'unique' AND feature_class IN ('intron', 'other_exon')
 AND gene_id IN (SELECT gene_id FROM cat WHERE assignment_status = 'unique' AND feature_class = 'terminal_exon')""", "cat"))
def pcpa_candidates(spark, d):
    study = Study(spark, d)
    return A.premature_candidates(study.catalog).select("pas_id", "gene_id", "feature_class")


@query(T.sql("""SELECT gene_id, transcript_id, chrom, strand, start, "end" FROM tx""", "tx"))
def terminal_exons(spark, d):
    return A.terminal_exons(T.exons(spark, d))


_MASK = """len(list_filter(range(CAST(greatest(0, pos - 5) AS BIGINT), CAST(least(pos, length(sequence) - 6) AS BIGINT) + 1), lambda o: substr(sequence, CAST(o AS BIGINT) + 1, 6) = repeat(base, 6))) > 0
 OR len(list_filter(range(CAST(greatest(0, pos - 9) AS BIGINT), CAST(least(pos, length(sequence) - 10) AS BIGINT) + 1), lambda o: 10 - length(replace(substr(sequence, CAST(o AS BIGINT) + 1, 10), base, '')) >= 7)) > 0"""


@query(T.sql(f"SELECT seq_id, pos, strand, {_MASK} AS masked FROM (SELECT *, CASE WHEN strand = '+' THEN 'A' ELSE 'T' END AS base FROM sq)", "sq"))
def internal_priming_mask(spark, d):
    return T.sequences(spark, d).select("seq_id", F.col("pos").cast("long").alias("pos"), "strand", G.internal_priming(F.col("sequence"), F.col("pos"), F.col("strand")).alias("masked"))


@query(T.sql("""SELECT seq_id, runs AS longest_a, length(sequence) - length(replace(sequence, 'A', '')) >= 0.7 * length(sequence) OR runs >= 6 AS a_rich,
 length(sequence) - length(replace(sequence, 'A', '')) >= 12 OR contains(sequence, 'AAAAAA') AS triggered FROM (
 SELECT *, CAST(coalesce(list_max(list_transform(regexp_extract_all(sequence, 'A+'), lambda x: length(x))), 0) AS INTEGER) AS runs FROM sq)""", "sq"))
def a_rich_confidence(spark, d):
    seq = F.col("sequence")
    return T.sequences(spark, d).select("seq_id", G.base_run(seq, "A").alias("longest_a"), G.a_rich(seq).alias("a_rich"), G.a_rich_trigger(seq).alias("triggered"))


@query(T.sql("SELECT seq_id, CASE " + " ".join(f"WHEN contains(sequence, '{m}') THEN '{m}'" for m in G.MOTIFS) + " END AS motif FROM sq", "sq"))
def motif_priority(spark, d):
    return T.sequences(spark, d).select("seq_id", G.first_motif(F.col("sequence")).alias("motif"))


@query(T.sql("SELECT seq_id, reverse(translate(sequence, 'ACGTNacgtn', 'TGCANtgcan')) AS reversed FROM sq", "sq"))
def reverse_complement(spark, d):
    return T.sequences(spark, d).select("seq_id", G.reverse_complement(F.col("sequence")).alias("reversed"))


@query(T.sql("""SELECT seq_id, CASE WHEN pos - 50 < 0 THEN NULL ELSE substr(sequence, CAST(pos - 50 AS BIGINT) + 1, 41) END AS upstream,
 CASE WHEN pos - 50 < 0 OR pos + 50 > length(sequence) THEN NULL ELSE substr(sequence, CAST(pos - 50 AS BIGINT) + 1, 100) END AS flank FROM sq""", "sq"))
def sequence_windows(spark, d):
    seq, pos = F.col("sequence"), F.col("pos")
    return T.sequences(spark, d).select(
        "seq_id",
        F.when(pos >= 50, F.substring(seq, pos - 49, F.lit(41))).alias("upstream"),
        F.when((pos >= 50) & (pos + 50 <= F.length(seq)), F.substring(seq, pos - 49, F.lit(100))).alias("flank"),
    )
