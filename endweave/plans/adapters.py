"""The driver's tables read as domain tables, and the same mapping as SQL.

Positions come from order keys, samples from suppliers, conditions from samples, and so on; every
mapping is deterministic. All cover the whole table but two: exons are of four orders in five, which
leaves introns and gaps, and known sites of every third order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHROM_SIZE = 2_000_000
EXTENSION, GENE_BIN = 100, 1000


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _chrom(i):
    return F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.pmod(i, F.lit(3)) + 1).cast("int"))


def alignments(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    plus = F.col("l_linestatus") == "F"
    pos = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    flag = (
        F.when(plus, 16).otherwise(0)
        + F.when(F.col("l_linenumber") == 7, 1024).otherwise(0)
        + F.when(F.col("l_partkey") % 53 == 0, 256).otherwise(0)
        + F.when(F.col("l_partkey") % 71 == 0, 2048).otherwise(0)
        + F.when(F.col("l_partkey") % 97 == 0, 4).otherwise(0)
    )
    nh = F.when(F.col("l_linenumber") == 6, 2).when(F.col("l_partkey") % 101 == 0, F.lit(None)).otherwise(1)
    clip = F.when(F.col("l_discount") >= 0.09, F.when(F.col("l_tax") >= 0.05, "5H").otherwise("5S")).otherwise("")
    return li.select(
        F.concat(F.lit("s"), (F.col("l_suppkey") % 6).cast("string")).alias("sample_id"),
        F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("read_name"),
        flag.cast("int").alias("flag"),
        F.col("l_returnflag").alias("chrom"),
        F.when(plus, pos - 29).otherwise(pos).cast("long").alias("ref_start"),
        F.when(plus, pos + 1).otherwise(pos + 30).cast("long").alias("ref_end"),
        F.when(plus, F.concat(F.lit("30M"), clip)).otherwise(F.concat(clip, F.lit("30M"))).alias("cigar"),
        nh.cast("int").alias("nh"),
    )


def samples(spark: SparkSession, d: str) -> DataFrame:
    rows = [(f"s{i}", "A" if i < 3 else "B", f"u{i % 3}") for i in range(6)]
    return spark.createDataFrame(rows, "sample_id string, condition string, subject string")


def sizes(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(c, CHROM_SIZE) for c in "ANR"], "chrom string, size long")


def exons(spark: SparkSession, d: str) -> DataFrame:
    """(gene_id, transcript_id, chrom, strand, start, end, kind): an exon of each order but every fifth."""
    o = table(spark, d, "orders").filter("o_orderkey % 5 <> 4")
    g = F.floor(F.col("o_orderkey") / 20)
    return o.select(
        F.concat(F.lit("g"), g.cast("string")).alias("gene_id"),
        F.concat(F.lit("g"), g.cast("string"), F.lit("t"), (F.col("o_orderkey") % 2).cast("string")).alias("transcript_id"),
        _chrom(g).alias("chrom"),
        F.when(F.floor(g / 3) % 2 == 0, "+").otherwise("-").alias("strand"),
        (F.col("o_orderkey") * 7).cast("long").alias("start"),
        (F.col("o_orderkey") * 7 + 4 + (F.col("o_orderkey") % 7)).cast("long").alias("end"),
        F.when(F.col("o_orderkey") % 5 == 1, "CDS").otherwise("exon").alias("kind"),
    )


def genes(spark: SparkSession, d: str) -> DataFrame:
    return exons(spark, d).groupBy("gene_id", "chrom", "strand").agg(F.min("start").alias("start"), F.max("end").alias("end"))


def known_sites(spark: SparkSession, d: str) -> DataFrame:
    """(chrom, strand, site, source_id): every third order, an unknown strand for every fifth of them."""
    o = table(spark, d, "orders").filter("o_orderkey % 3 = 0")
    return o.select(
        _chrom(F.floor(F.col("o_orderkey") / 7)).alias("chrom"),
        F.when(F.col("o_orderkey") % 5 == 0, ".").when(F.col("o_orderkey") % 2 == 0, "+").otherwise("-").alias("strand"),
        (F.col("o_orderkey") * 7 + 2).cast("long").alias("site"),
        F.concat(F.lit("k"), F.col("o_orderkey").cast("string")).alias("source_id"),
    )


def sequences(spark: SparkSession, d: str) -> DataFrame:
    """(seq_id, sequence, pos, strand): document texts over the alphabet ACGTN, and a position in each."""
    doc = table(spark, d, "documents")
    seq = F.regexp_replace(F.translate(F.lower(F.coalesce("text", F.lit(""))), "aeioubcdfghjklmnpqrstvwxyz", "AAAATCGTCGTCGTACGTCATAGCGT"), "[^ACGT]", "N")
    return doc.select(
        F.col("doc_id").alias("seq_id"),
        seq.alias("sequence"),
        F.when(F.length(seq) > 0, F.pmod(F.col("doc_id") * 37, F.length(seq))).otherwise(0).cast("int").alias("pos"),
        F.when(F.col("doc_id") % 2 == 0, "+").otherwise("-").alias("strand"),
    )


def results(spark: SparkSession, d: str) -> DataFrame:
    """(contrast_id, gene_id, effect, pvalue, stat): made-up test results of each gene, some missing."""
    g = genes(spark, d).select("gene_id", F.substring("gene_id", F.lit(2), F.lit(20)).cast("long").alias("g"))
    c = g.withColumn("c", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    return c.select(
        F.concat(F.lit("c"), F.col("c").cast("string")).alias("contrast_id"),
        "gene_id",
        (((F.col("g") * 31 + F.col("c") * 17) % 201 - 100) / F.lit(25.0)).alias("effect"),
        F.when((F.col("g") + F.col("c")) % 11 != 0, (F.pow((F.col("g") * 7919 + F.col("c") * 104729) % 1009 + 1, F.lit(2)) / F.lit(1020100.0 * 4))).alias("pvalue"),
        F.when((F.col("g") + F.col("c")) % 13 != 0, ((F.col("g") * 17 + F.col("c") * 5) % 401 - 200) / F.lit(50.0)).alias("stat"),
    )


#: The same tables for the SQL engine: name -> (definition, tables it needs).
SQL = {
    "al": (
        """SELECT 's' || (l_suppkey % 6) AS sample_id, concat_ws('/', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rid,
  (CASE WHEN l_linestatus = 'F' THEN 16 ELSE 0 END + CASE WHEN l_linenumber = 7 THEN 1024 ELSE 0 END
   + CASE WHEN l_partkey % 53 = 0 THEN 256 ELSE 0 END + CASE WHEN l_partkey % 71 = 0 THEN 2048 ELSE 0 END
   + CASE WHEN l_partkey % 97 = 0 THEN 4 ELSE 0 END) AS flag,
  l_returnflag AS chrom,
  CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand,
  l_orderkey * 7 + l_linenumber AS pos,
  CASE WHEN l_linestatus = 'F' THEN l_orderkey * 7 + l_linenumber - 29 ELSE l_orderkey * 7 + l_linenumber END AS ref_start,
  CASE WHEN l_linestatus = 'F' THEN l_orderkey * 7 + l_linenumber + 1 ELSE l_orderkey * 7 + l_linenumber + 30 END AS ref_end,
  l_discount >= 0.09 AS clip, l_discount >= 0.09 AND l_tax < 0.05 AS soft,
  CASE WHEN l_linenumber = 6 THEN 2 WHEN l_partkey % 101 = 0 THEN NULL ELSE 1 END AS nh
FROM lineitem""",
        (),
    ),
    "c0": ("SELECT * FROM al WHERE (flag & 2308) = 0 AND coalesce(nh, 0) = 1", ("al",)),
    "en": (
        """SELECT sample_id, chrom, strand, pos, CAST(count(*) FILTER (WHERE NOT clip) AS BIGINT) AS unclipped,
  CAST(count(*) FILTER (WHERE clip) AS BIGINT) AS clipped FROM c0 GROUP BY ALL""",
        ("c0",),
    ),
    "smp": ("SELECT 's' || i AS sample_id, CASE WHEN i < 3 THEN 'A' ELSE 'B' END AS condition, 'u' || (i % 3) AS subject FROM range(6) t(i)", ()),
    "sz": ("SELECT unnest(['A', 'N', 'R']) AS chrom, 2000000 AS size", ()),
    "ex": (
        """SELECT 'g' || (o_orderkey // 20) AS gene_id, 'g' || (o_orderkey // 20) || 't' || (o_orderkey % 2) AS transcript_id,
  (['A', 'N', 'R'])[(o_orderkey // 20) % 3 + 1] AS chrom,
  CASE WHEN (o_orderkey // 60) % 2 = 0 THEN '+' ELSE '-' END AS strand,
  o_orderkey * 7 AS start, o_orderkey * 7 + 4 + o_orderkey % 7 AS "end",
  CASE WHEN o_orderkey % 5 = 1 THEN 'CDS' ELSE 'exon' END AS kind
FROM orders WHERE o_orderkey % 5 <> 4""",
        (),
    ),
    "gn": ('SELECT gene_id, chrom, strand, min(start) AS start, max("end") AS "end" FROM ex GROUP BY ALL', ("ex",)),
    "kn": (
        """SELECT (['A', 'N', 'R'])[(o_orderkey // 7) % 3 + 1] AS chrom,
  CASE WHEN o_orderkey % 5 = 0 THEN '.' WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
  o_orderkey * 7 + 2 AS site, 'k' || o_orderkey AS source_id FROM orders WHERE o_orderkey % 3 = 0""",
        (),
    ),
    "k2": ("SELECT chrom, unnest(CASE WHEN strand = '.' THEN ['+', '-'] ELSE [strand] END) AS strand, site, source_id FROM kn", ("kn",)),
    "sq": (
        """SELECT doc_id AS seq_id, sequence, CASE WHEN length(sequence) > 0 THEN (doc_id * 37) % length(sequence) ELSE 0 END AS pos,
  CASE WHEN doc_id % 2 = 0 THEN '+' ELSE '-' END AS strand
FROM (SELECT doc_id, regexp_replace(translate(lower(coalesce(text, '')), 'aeioubcdfghjklmnpqrstvwxyz', 'AAAATCGTCGTCGTACGTCATAGCGT'), '[^ACGT]', 'N', 'g') AS sequence FROM documents)""",
        (),
    ),
    "c1": ("SELECT sample_id, chrom, strand, pos, unclipped AS count, pos % 17 = 0 AS masked FROM en WHERE unclipped > 0", ("en",)),
    "c2r": (
        """SELECT sample_id, chrom, strand, pos, count, masked,
  EXISTS (SELECT 1 FROM k2 WHERE k2.chrom = c1.chrom AND k2.strand = c1.strand AND k2.site BETWEEN c1.pos - 10 AND c1.pos + 9) AS rescued FROM c1""",
        ("c1", "k2"),
    ),
    "c2": ("SELECT sample_id, chrom, strand, pos, count FROM c2r WHERE NOT masked OR rescued", ("c2r",)),
    "tot": ("SELECT sample_id, sum(count) AS total FROM c2 GROUP BY ALL", ("c2",)),
    "pl": (
        """SELECT chrom, strand, pos, sum(CAST(round(count * 1e6 / total, 6) AS DECIMAL(28,6))) AS cpm
FROM c2 JOIN tot USING (sample_id) GROUP BY ALL""",
        ("c2", "tot"),
    ),
    "th": ("SELECT CAST(round(5 * 6e6 / sum(count), 6) AS DECIMAL(28,6)) AS threshold FROM c2", ("c2",)),
    "ev": (
        """SELECT chrom, strand, x, sum(v) AS v FROM (SELECT chrom, strand, pos - 29 AS x, cpm AS v FROM pl
  UNION ALL SELECT chrom, strand, pos + 1, -cpm FROM pl) GROUP BY ALL""",
        ("pl",),
    ),
    "sw": (
        """SELECT chrom, strand, x, sum(v) OVER (PARTITION BY chrom, strand ORDER BY x ROWS UNBOUNDED PRECEDING) AS score,
  lead(x) OVER (PARTITION BY chrom, strand ORDER BY x) AS nx FROM ev""",
        ("ev",),
    ),
    "cp": (
        """SELECT chrom, strand, min(s) AS start, max(e) AS "end" FROM (
  SELECT *, sum(new) OVER (PARTITION BY chrom, strand ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM (
    SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY chrom, strand ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new
    FROM (SELECT chrom, strand, x AS s, nx + 29 AS e FROM sw, th WHERE score > threshold AND nx IS NOT NULL)))
GROUP BY chrom, strand, island""",
        ("sw", "th"),
    ),
    "r1": (
        """SELECT chrom, strand, summit, greatest(0, summit - 14) AS start, least(size, summit + 16) AS "end" FROM (
  SELECT cp.chrom, cp.strand, cp.start, arg_max(pos, cpm * 100000000 - CAST(pos AS DECIMAL(28,6)) / 10) AS summit
  FROM cp JOIN pl ON pl.chrom = cp.chrom AND pl.strand = cp.strand AND pos >= cp.start AND pos < cp."end" GROUP BY ALL) JOIN sz USING (chrom)""",
        ("cp", "pl", "sz"),
    ),
    "m1": (
        """SELECT chrom, strand, min(start) AS start, max("end") AS "end" FROM (
  SELECT *, sum(new) OVER (PARTITION BY chrom, strand ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM (
    SELECT *, CASE WHEN start <= max("end") OVER (PARTITION BY chrom, strand ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM r1))
GROUP BY chrom, strand, island""",
        ("r1",),
    ),
    "st": (
        """SELECT chrom, strand, summit, start, "end", 'PAS_' || lpad(CAST(row_number() OVER (ORDER BY chrom, start, strand, summit) AS VARCHAR), 8, '0') AS pas_id FROM (
  SELECT chrom, strand, summit, greatest(0, summit - 14) AS start, least(size, summit + 16) AS "end" FROM (
    SELECT m1.chrom, m1.strand, m1.start, arg_max(pos, cpm * 100000000 - CAST(pos AS DECIMAL(28,6)) / 10) AS summit
    FROM m1 JOIN pl ON pl.chrom = m1.chrom AND pl.strand = m1.strand AND pos >= m1.start AND pos < m1."end" GROUP BY ALL) JOIN sz USING (chrom))""",
        ("m1", "pl", "sz"),
    ),
    "ct": (
        """SELECT st.pas_id, smp.sample_id, CAST(coalesce(sum(c2.count), 0) AS BIGINT) AS count FROM st CROSS JOIN smp
LEFT JOIN c2 ON c2.sample_id = smp.sample_id AND c2.chrom = st.chrom AND c2.strand = st.strand AND c2.pos >= st.start AND c2.pos < st."end" GROUP BY ALL""",
        ("st", "smp", "c2"),
    ),
    "tx": (
        """SELECT gene_id, transcript_id, chrom, strand,
  CASE WHEN strand = '+' THEN arg_max(start, "end") ELSE min(start) END AS start,
  CASE WHEN strand = '+' THEN max("end") ELSE arg_min("end", start) END AS "end" FROM ex GROUP BY gene_id, transcript_id, chrom, strand""",
        ("ex",),
    ),
    "hit": (
        """SELECT pas_id, gn.gene_id,
  CASE WHEN EXISTS (SELECT 1 FROM tx WHERE tx.gene_id = gn.gene_id AND summit >= tx.start AND summit < tx."end") THEN 'terminal_exon'
       WHEN EXISTS (SELECT 1 FROM ex WHERE ex.gene_id = gn.gene_id AND summit >= ex.start AND summit < ex."end") THEN 'other_exon'
       WHEN summit >= gn.start AND summit < gn."end" THEN 'intron' ELSE 'downstream_extension' END AS feature
FROM st JOIN gn ON gn.chrom = st.chrom AND gn.strand = st.strand
  AND summit >= CASE WHEN gn.strand = '-' THEN greatest(0, gn.start - 100) ELSE gn.start END
  AND summit < CASE WHEN gn.strand = '+' THEN gn."end" + 100 ELSE gn."end" END""",
        ("st", "gn", "tx", "ex"),
    ),
    "cat": (
        """SELECT st.*, CASE WHEN n IS NULL THEN '' ELSE ids END AS gene_id,
  CASE WHEN n = 1 THEN feature WHEN n > 1 THEN 'ambiguous'
       WHEN EXISTS (SELECT 1 FROM gn WHERE gn.chrom = st.chrom AND gn.strand <> st.strand AND summit >= gn.start AND summit < gn."end") THEN 'antisense' ELSE 'intergenic' END AS feature_class,
  CASE WHEN n = 1 THEN 'unique' WHEN n > 1 THEN 'ambiguous_multi_gene' ELSE 'unassigned' END AS assignment_status
FROM st LEFT JOIN (SELECT pas_id, count(*) AS n, min(feature) AS feature, string_agg(gene_id, ';' ORDER BY gene_id) AS ids FROM hit GROUP BY pas_id) h USING (pas_id)""",
        ("st", "hit", "gn"),
    ),
    "rs": (
        """SELECT 'c' || c AS contrast_id, gene_id, ((g * 31 + c * 17) % 201 - 100) / 25.0 AS effect,
  CASE WHEN (g + c) % 11 <> 0 THEN pow((g * 7919 + c * 104729) % 1009 + 1, 2) / 4080400.0 END AS pvalue,
  CASE WHEN (g + c) % 13 <> 0 THEN ((g * 17 + c * 5) % 401 - 200) / 50.0 END AS stat
FROM (SELECT gene_id, CAST(substr(gene_id, 2) AS BIGINT) AS g FROM gn), range(3) t(c)""",
        ("gn",),
    ),
}


def sql(body: str, *needs: str, **more: str) -> str:
    """``body`` behind the definitions it needs, in order; ``more`` are further ones of its own."""
    found: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in found:
            for other in SQL[name][1]:
                add(other)
            found[name] = SQL[name][0]

    for name in needs:
        add(name)
    found |= more
    if not found:
        return body
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in found.items()) + "\n" + body
