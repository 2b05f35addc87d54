"""Queries that write domain files from the test tables and read them back, to the shared folder that
checkpoints go to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from endweave.plans import adapters as T
from endweave.plans.core import _MASK
from endweave.plans.registry import query, sql_of
from endweave.plans.statistics import r6
from endweave.session import ensure_checkpoint_dir
from endweave.sources import bam
from endweave.sources import readers as R
from endweave.sources import writers as W


def _place(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/files-{uuid.uuid4().hex}"


def _text(lines: DataFrame, *by: str) -> str:
    """The folder to which lines (value) were written, with one folder for each value of ``by``."""
    path = _place(lines.sparkSession)
    lines.write.partitionBy(*by).text(path)
    return path


def _table(df: DataFrame) -> str:
    path = _place(df.sparkSession)
    W.write_table(df, path)
    return path


def _tabbed(*columns) -> F.Column:
    return F.concat_ws("\t", *[F.col(c) if isinstance(c, str) else c for c in columns])


@query(T.sql("""SELECT chrom, site AS start, site + 1 AS "end", source_id AS name, '0' AS score, strand FROM kn""", "kn"))
def bed_file(spark, d):
    sites = T.known_sites(spark, d)
    bed = sites.select("chrom", F.col("site").alias("start"), (F.col("site") + 1).alias("end"), F.col("source_id").alias("name"), F.lit(0).alias("score"), "strand")
    path = _place(spark)
    W.write_bed(bed, path)
    return R.read_bed(spark, path)


@query(T.sql("""SELECT gene_id AS "GeneID", chrom AS "Chr", CAST(start + 1 AS VARCHAR) AS "Start", CAST("end" AS VARCHAR) AS "End", strand AS "Strand" FROM ex""", "ex"))
def saf_file(spark, d):
    saf = W.as_saf(T.exons(spark, d))
    return R.read_table(spark, _table(saf), saf.columns)


@query(T.sql("SELECT contrast_id, gene_id, round(effect, 6) AS effect, round(pvalue, 6) AS pvalue, round(stat, 6) AS stat FROM rs", "rs"))
def result_file(spark, d):
    results = T.results(spark, d)
    rows = R.read_table(spark, _table(results), results.columns)
    return rows.select("contrast_id", "gene_id", *[R.number(F.col(c)).alias(c) for c in ("effect", "pvalue", "stat")]).select("contrast_id", "gene_id", *r6("effect", "pvalue", "stat"))


@query(T.sql("SELECT chrom, strand, pos, CAST(sum(unclipped) AS BIGINT) AS count FROM en WHERE unclipped > 0 GROUP BY ALL", "en"))
def position_file(spark, d):
    """Zero counts are written and left out by the reader, which sums the samples' rows."""
    from endweave.plans.core import Study

    ends = Study(spark, d).ends
    return R.read_positions(spark, _table(ends.select("chrom", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), "strand", F.col("unclipped").alias("count"))))


@query(T.sql("SELECT sample_id, chrom, strand, pos, unclipped, clipped FROM en", "en"))
def position_folders(spark, d):
    from endweave.plans.core import Study

    path = _place(spark)
    W.write_positions(Study(spark, d).ends.select("sample_id", "chrom", "strand", "pos", "unclipped", "clipped"), path)
    return spark.read.parquet(path)


_CIGAR = "(CASE WHEN NOT clip THEN '' WHEN soft THEN '5S' ELSE '5H' END)"


@query(T.sql(f"""SELECT 'x' AS sample_id, rid AS read_name, flag, chrom, ref_start, ref_end, nh,
 CASE WHEN strand = '+' THEN '30M' || {_CIGAR} ELSE {_CIGAR} || '30M' END AS cigar FROM al WHERE ref_start >= 0""", "al"))
def alignment_file(spark, d):
    reads = T.alignments(spark, d).filter("ref_start >= 0")
    tag = F.when(F.col("nh").isNotNull(), F.concat(F.lit("NH:i:"), F.col("nh").cast("string")))
    none = F.lit("*")
    lines = reads.select(_tabbed("read_name", "flag", "chrom", F.col("ref_start") + 1, F.lit(60), "cigar", none, F.lit(0), F.lit(0), none, none, tag).alias("value"))
    header = spark.createDataFrame([("@HD\tVN:1.6",)], "value string")
    return R.read_alignments(spark, _text(header.union(lines)), "x")


#: Chains made of orders: one for every twenty orders, of three blocks, every fourth to the other strand,
#: every fifth with a second one elsewhere.
_CHAINS = {
    "cg": "SELECT DISTINCT o_orderkey // 20 AS g FROM orders",
    "cn": "SELECT g, 'c' || g AS chain_id, CAST(0 AS BIGINT) AS more FROM cg UNION ALL SELECT g, 'd' || g, 500000000 FROM cg WHERE g % 5 = 0",
    "cb": """SELECT chain_id, ['A', 'N', 'R'][g % 3 + 1] AS chrom, g * 140 + a AS start, g * 140 + b AS "end", 'to' || (g % 7) AS to_chrom, g * 140 + 1000 + more + q AS to_start,
  CASE WHEN g % 4 = 0 THEN '-' ELSE '+' END AS to_strand, 1000000000 AS to_size FROM cn, (VALUES (0, 40, 0), (50, 80, 45), (95, 115, 100)) v(a, b, q)""",
    "ch": """SELECT source_id, to_chrom, chain_id, CASE WHEN to_strand = '-' THEN to_size - 1 - (to_start + site - start) ELSE to_start + site - start END AS to_pos,
  CASE WHEN to_strand = '+' THEN kn.strand WHEN kn.strand = '+' THEN '-' WHEN kn.strand = '-' THEN '+' ELSE kn.strand END AS to_strand FROM kn JOIN cb ON cb.chrom = kn.chrom AND site >= start AND site < \"end\"""",
}


def _chains(spark, d) -> DataFrame:
    """The chains as text, read back as blocks."""
    g = T.table(spark, d, "orders").select(F.floor(F.col("o_orderkey") / 20).alias("g")).distinct()
    both = g.select("g", F.concat(F.lit("c"), F.col("g").cast("string")).alias("id"), F.lit(0).alias("more"))
    both = both.union(g.filter("g % 5 = 0").select("g", F.concat(F.lit("d"), F.col("g").cast("string")), F.lit(500_000_000)))
    at, there = F.col("g") * 140, F.col("g") * 140 + 1000 + F.col("more")
    chrom = F.element_at(F.array(*map(F.lit, "ANR")), (F.col("g") % 3 + 1).cast("int"))
    head = F.concat_ws(" ", F.lit("chain 99"), chrom, F.lit("2000000000 +"), at, at + 115, F.concat(F.lit("to"), F.col("g") % 7), F.lit(10**9), F.when(F.col("g") % 4 == 0, "-").otherwise("+"), there, there + 120, "id")
    return R.read_chains(spark, _text(both.select(F.concat(head, F.lit("\n40\t10\t5\n30\t15\t25\n20\n")).alias("value"))))


@query(T.sql('SELECT chain_id, chrom, start, "end", to_chrom, to_start, to_strand, CAST(to_size AS BIGINT) AS to_size FROM cb', **_CHAINS))
def chain_file(spark, d):
    return _chains(spark, d)


@query(T.sql("SELECT source_id, to_chrom, CAST(to_pos AS BIGINT) AS to_pos, to_strand, chain_id FROM ch", "kn", **_CHAINS))
def chain_hits(spark, d):
    from endweave.operators import liftover

    return liftover.hits(T.known_sites(spark, d), _chains(spark, d), pos="site")


@query(T.sql("""SELECT source_id, CASE WHEN n IS NULL THEN 'unmapped' WHEN n > 1 THEN 'multiple' WHEN h.to_strand <> strand THEN 'strand_changed' ELSE 'lifted' END AS status,
 CASE WHEN n = 1 AND h.to_strand = strand THEN to_chrom END AS to_chrom, CASE WHEN n = 1 AND h.to_strand = strand THEN to_pos END AS to_pos
 FROM kn LEFT JOIN (SELECT source_id, count(*) AS n, min(to_chrom) AS to_chrom, CAST(min(to_pos) AS BIGINT) AS to_pos, min(to_strand) AS to_strand FROM ch GROUP BY 1) h USING (source_id)""", "kn", **_CHAINS))
def chain_lifted(spark, d):
    """Outcomes by all hits: a gap or no chain, several, another strand, one."""
    from endweave.operators import atlas, liftover

    sites = T.known_sites(spark, d)
    return atlas.lifted(sites, liftover.hits(sites, _chains(spark, d), pos="site")).select("source_id", "status", "to_chrom", "to_pos")


#: Bytes of the ranges in which the queries read binary alignments where they find few, so that small files
#: have several.
_RANGE = 1 << 18


def _binary(spark, reads: DataFrame) -> DataFrame:
    """Written by as many tasks as the table is read by; a file of many bytes is cut into eight ranges."""
    path = _place(spark)
    W.write_bam(reads, path, [(c, 2**31 - 1) for c in "ANR"])
    return R.read_bam(spark, path, "x", max(_RANGE, min(bam.SPLIT, bam.largest(path) // 8)))


@query(T.sql(f"""SELECT 'x' AS sample_id, rid AS read_name, flag, chrom, ref_start, ref_end, nh,
 CASE WHEN strand = '+' THEN '30M' || {_CIGAR} ELSE {_CIGAR} || '30M' END AS cigar FROM al WHERE ref_start >= 0""", "al"))
def binary_alignment_file(spark, d):
    """Written in blocks and read in ranges of _RANGE bytes or more."""
    return _binary(spark, T.alignments(spark, d).filter("ref_start >= 0"))


@query(T.sql("""SELECT chrom, strand, pos, CAST(count(*) AS BIGINT) AS count FROM al WHERE ref_start >= 0 AND (flag & 2308) = 0 GROUP BY ALL""", "al"))
def binary_endpoints(spark, d):
    """Ends from binary files, whatever a read's number of hits."""
    from endweave.operators import ends as E

    return E.endpoint_counts(_binary(spark, T.alignments(spark, d).filter("ref_start >= 0"))).drop("sample_id")


@query(T.sql("""SELECT sample_id, CAST(count(*) AS BIGINT) AS records, CAST(count(*) FILTER (WHERE (flag & 65) = 65 AND ok) AS BIGINT) AS eligible,
 CAST(count(*) FILTER (WHERE (flag & 65) = 65 AND ok AND flag & 1024 <> 0) AS BIGINT) AS duplicates_kept,
 CAST(count(*) FILTER (WHERE (flag & 65) = 65 AND ok AND soft) AS BIGINT) AS clipped_kept,
 CAST(count(*) FILTER (WHERE (flag & 65) <> 65) AS BIGINT) AS other_mates,
 CAST(count(DISTINCT struct_pack(c := chrom, s := strand, p := pos)) FILTER (WHERE (flag & 65) = 65 AND ok) AS BIGINT) AS places
 FROM (SELECT sample_id, chrom, strand, pos, soft, (flag & 2308) = 0 AS ok, flag | 1 | CASE WHEN nh IS NULL OR nh = 2 THEN 128 ELSE 64 END AS flag FROM al) GROUP BY 1""", "al"))
def endpoint_audit(spark, d):
    """Pairs: reads without a number of hits, or with two, stand for second mates."""
    from endweave.operators import ends as E

    mate = F.when(F.coalesce("nh", F.lit(2)) == 2, 128).otherwise(64)
    pairs = T.alignments(spark, d).withColumn("flag", F.col("flag").bitwiseOR(F.lit(1)).bitwiseOR(mate))
    return E.endpoint_audit(pairs, "PE")


@query("""SELECT concat_ws('/', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS read_name, l_orderkey * 7 + a AS start, l_orderkey * 7 + b AS "end"
 FROM lineitem JOIN (VALUES (0, 0, 30), (1, 0, 30), (2, 0, 12), (2, 18, 30)) v(kind, a, b) ON l_linenumber % 3 = kind""")
def alignment_blocks(spark, d):
    """Reads with a deletion, which stays in its block, and with a gap, which parts two."""
    cigar = F.element_at(F.array(F.lit("3S30M"), F.lit("10M2D18M"), F.lit("12M6N10M4I2M1H")), (F.col("l_linenumber") % 3 + 1).cast("int"))
    name = F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    none = F.lit("*")
    lines = T.table(spark, d, "lineitem").select(_tabbed(name, F.lit(0), F.lit("A"), F.col("l_orderkey") * 7 + 1, F.lit(60), cigar, none, F.lit(0), F.lit(0), none, none).alias("value"))
    return R.aligned_blocks(R.read_alignments(spark, _text(lines), "x")).select("read_name", "start", "end")


def _annotation(spark, d) -> DataFrame:
    """Exons as an annotation file, with a transcript of each end and comments."""
    exons = T.exons(spark, d)
    ends = exons.groupBy("gene_id", "transcript_id", "chrom", "strand").agg(F.min("start").alias("start"), F.max("end").alias("end")).withColumn("kind", F.lit("transcript"))
    rows = exons.unionByName(ends)
    kind = F.when(F.col("kind") == "CDS", F.lit('gene_biotype "coding"; ')).when(F.col("kind") == "exon", F.lit('gene_type "other"; ')).otherwise("")
    notes = F.concat(F.lit('gene_id "'), "gene_id", F.lit('"; transcript_id "'), "transcript_id", F.lit('"; '), kind, F.lit('tag "a"; tag "b";'))
    lines = rows.select(_tabbed("chrom", F.lit("made"), "kind", F.col("start") + 1, "end", F.lit("."), "strand", F.lit("."), notes).alias("value"))
    header = spark.createDataFrame([("#!genome made",), ("A\tmade\texon\t1\t2",)], "value string")
    return R.read_gtf(spark, _text(header.union(lines)))


@query(T.sql("""SELECT chrom, kind AS feature, start, "end", strand, gene_id, transcript_id, CASE WHEN kind = 'CDS' THEN 'coding' ELSE 'other' END AS biotype FROM ex
 UNION ALL SELECT chrom, 'transcript', min(start), max("end"), strand, gene_id, transcript_id, NULL FROM ex GROUP BY chrom, strand, gene_id, transcript_id""", "ex"))
def annotation_file(spark, d):
    return _annotation(spark, d).drop("gene_name")


@query(T.sql("""SELECT gene_id, chrom, strand, min(start) AS start, max("end") AS "end", max(CASE WHEN kind = 'CDS' THEN 'coding' ELSE 'other' END) AS biotype FROM ex GROUP BY 1, 2, 3""", "ex"))
def annotation_gene_spans(spark, d):
    return R.gene_spans(_annotation(spark, d))


@query(T.sql("""SELECT chrom, strand, CASE WHEN strand = '+' THEN max("end") - 1 ELSE min(start) END AS site FROM ex GROUP BY chrom, strand, gene_id, transcript_id""", "ex"))
def annotation_transcript_ends(spark, d):
    return R.transcript_ends(_annotation(spark, d))


@query("SELECT 'n' || c_custkey AS chrom, c_custkey % 7 AS size FROM customer WHERE c_custkey % 7 > 0")
def size_file(spark, d):
    """Sizes of 0 and comments are left out."""
    lines = T.table(spark, d, "customer").select(F.concat(F.lit("n"), F.col("c_custkey").cast("string"), F.lit("  "), (F.col("c_custkey") % 7).cast("string")).alias("value"))
    return R.read_sizes(spark, _text(spark.createDataFrame([("# sizes",), ("",)], "value string").union(lines)))


@query("""SELECT 'p' || p AS gene_id, 's' || i AS sample_id, CAST(count(l_partkey) AS BIGINT) AS count FROM (SELECT DISTINCT l_partkey AS p FROM lineitem) CROSS JOIN range(6) t(i)
 LEFT JOIN lineitem ON l_partkey = p AND l_suppkey % 6 = i GROUP BY ALL""")
def matrix_file(spark, d):
    names = [f"s{i}" for i in range(6)]
    gene = F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("gene_id")
    wide = T.table(spark, d, "lineitem").groupBy(gene).agg(*[F.count_if(F.col("l_suppkey") % 6 == i).alias(n) for i, n in enumerate(names)])
    return R.read_matrix(spark, _table(wide), "gene_id", names)


@query("SELECT 's' || (p_partkey % 4) AS sample_id, CAST(sum(p_size) AS BIGINT) AS forward, CAST(sum(p_size * 9 + 1) AS BIGINT) AS reverse FROM part GROUP BY 1")
def strand_count_file(spark, d):
    sample = F.concat(F.lit("s"), (F.col("p_partkey") % 4).cast("string")).alias("sample_id")
    lines = T.table(spark, d, "part").select(sample, _tabbed(F.concat(F.lit("g"), F.col("p_partkey").cast("string")), F.col("p_size") * 10 + 1, "p_size", F.col("p_size") * 9 + 1).alias("value"))
    summary = lines.select("sample_id").distinct().select("sample_id", F.lit("N_unmapped\t5\t6\t7").alias("value"))
    counts = R.read_strand_counts(spark, _text(lines.union(summary), "sample_id"))
    return counts.groupBy(F.regexp_extract("file", "sample_id=([^/]+)", 1).alias("sample_id")).agg(F.sum("forward").alias("forward"), F.sum("reverse").alias("reverse"))


@query("SELECT s_name AS key, s_suppkey || '%' AS value FROM supplier")
def key_value_file(spark, d):
    lines = T.table(spark, d, "supplier").select(F.concat(F.lit("   "), "s_name", F.lit(" |\t"), F.col("s_suppkey").cast("string"), F.lit("%")).alias("value"))
    return R.read_key_values(spark, _text(lines.union(spark.createDataFrame([("  UNIQUE READS:",)], "value string")))).select("key", "value")


@query("""SELECT 'd' || p_partkey AS database, p_partkey * 10 AS reads, p_size / 4.0 AS unmapped, p_size / 2.0 AS one, CAST(0.5 AS DOUBLE) AS several, CAST(0.25 AS DOUBLE) AS one_many, CAST(NULL AS DOUBLE) AS several_many FROM part""")
def screen_file(spark, d):
    size, half = F.col("p_size"), lambda n: (F.col("p_size") / n).cast("double").cast("string")
    zero = F.lit(0)
    lines = T.table(spark, d, "part").select(
        _tabbed(F.concat(F.lit("d"), F.col("p_partkey").cast("string")), F.col("p_partkey") * 10, size, half(4), size, half(2), zero, F.lit("0.5"), zero, F.lit("0.25"), zero, F.lit("-")).alias("value")
    )
    head = spark.createDataFrame([("#Screen version: 1",), ("Genome\tReads\t" + "\t".join("x" * 10),)], "value string")
    rows = R.read_contamination(spark, _text(head.union(lines)))
    return rows.drop("file")


@query("""SELECT 'n' || n_nationkey AS sample_id, CAST(0.25 AS DOUBLE) AS undetermined, n_nationkey / 64.0 AS forward, n_regionkey / 8.0 AS reverse,
 CASE WHEN n_regionkey / 8.0 > n_nationkey / 64.0 THEN 'reverse' WHEN n_regionkey / 8.0 < n_nationkey / 64.0 THEN 'forward' ELSE 'undetermined' END AS dominant FROM nation""")
def orientation_file(spark, d):
    share = lambda c, n: (F.col(c) / n).cast("double").cast("string")
    text = F.concat(F.lit('This is SingleEnd Data\nFraction of reads failed to determine: 0.25\nFraction of reads explained by "++,--": '), share("n_nationkey", 64), F.lit('\nFraction of reads explained by "+-,-+": '), share("n_regionkey", 8))
    rows = R.read_orientation(spark, _text(T.table(spark, d, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("sample_id"), text.alias("value")), "sample_id"))
    return rows.select(F.regexp_extract("file", "sample_id=([^/]+)", 1).alias("sample_id"), "undetermined", "forward", "reverse", "dominant")


@query("SELECT 'x' || c_custkey AS feature_id, CAST(c_custkey % 2 AS INTEGER) AS label FROM customer")
def label_file(spark, d):
    """Commas and tabs, ids with and without a mark, whole numbers and decimals, a header."""
    key = F.col("c_custkey")
    mark, part = F.when(key % 3 == 0, ">").otherwise(""), F.when(key % 5 == 0, "\t").otherwise(",")
    lines = T.table(spark, d, "customer").select(F.concat(mark, F.lit("x"), key.cast("string"), part, (key % 2).cast("string"), F.when(key % 7 == 0, ".0").otherwise("")).alias("value"))
    return R.read_labels(spark, _text(lines.union(spark.createDataFrame([("id,predicted",)], "value string"))))


@query("SELECT n_name AS step, CAST(n_regionkey AS BIGINT) AS rows, n_name || ';b' AS notes FROM nation")
def json_file(spark, d):
    """One document a file."""
    nation = T.table(spark, d, "nation").select(F.col("n_name").alias("step"), F.col("n_regionkey").cast("long").alias("rows"), F.array("n_name", F.lit("b")).alias("notes"), F.col("n_nationkey").alias("key"))
    path = _place(spark)
    nation.write.partitionBy("key").json(path)
    return R.read_documents_json(spark, path, "step string, rows long, notes array<string>").select("step", "rows", F.array_join("notes", ";").alias("notes"))


_SHEET = """SELECT CASE WHEN c_custkey % 17 = 0 THEN '-' ELSE '' END || 'S' || (c_custkey // 6) AS sample_id, 'T' || (c_custkey % 2) AS rep, 'L' || (c_custkey % 3 % 2) AS lane,
 'f' || (c_custkey // 4) AS r1, CASE WHEN c_custkey % 2 = 0 THEN 'r' || c_custkey ELSE '' END AS r2, CASE WHEN c_custkey % 23 = 0 THEN 'B' ELSE 'A' END AS condition FROM customer"""


@query(f"""WITH sh AS ({_SHEET})
SELECT 'repeated_lane' AS fault, concat_ws('/', sample_id, rep, lane) AS key, CAST(count(*) AS BIGINT) AS rows FROM sh GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'repeated_file', f, CAST(count(*) AS BIGINT) FROM (SELECT r1 AS f FROM sh UNION ALL SELECT r2 FROM sh) WHERE f <> '' GROUP BY 2 HAVING count(*) > 1
UNION ALL SELECT 'inconsistent_sample', sample_id, CAST(count(DISTINCT condition) AS BIGINT) FROM sh GROUP BY 2 HAVING count(DISTINCT condition) > 1
UNION ALL SELECT 'unsafe_id', sample_id, CAST(count(*) AS BIGINT) FROM sh WHERE starts_with(sample_id, '-') GROUP BY 2""")
def sheet_file(spark, d):
    """A sample sheet's faults; one genome under two names is no fault."""
    key = F.col("c_custkey")
    part = lambda mark, value: F.concat(F.lit(mark), value.cast("string"))
    made = {
        "sample_id": F.concat(F.when(key % 17 == 0, "-").otherwise(""), part("S", F.floor(key / 6))), "genome": F.when(key % 2 == 0, "hg38").otherwise("GRCh38"),
        "technical_replicate_id": part("T", key % 2), "lane_id": part("L", key % 3 % 2), "fastq_r1": part("f", F.floor(key / 4)),
        "fastq_r2": F.when(key % 2 == 0, part("r", key)).otherwise(""), "condition": F.when(key % 23 == 0, "B").otherwise("A"),
    }
    path = _place(spark)
    T.table(spark, d, "customer").select(*[made.get(c, F.lit("x")).alias(c) for c in R.SHEET]).write.csv(path, header=True, emptyValue="")
    return R.sheet_faults(R.read_sample_sheet(spark, path).fillna(""))


@query("SELECT DISTINCT p_brand AS database, p_type AS term_id, 'about ' || p_type AS term_name, 'g' || (p_partkey % 100) AS gene_id FROM part WHERE p_partkey % 9 > 0")
def gene_set_file(spark, d):
    """Rows without a term are left out, versions of genes go."""
    key = F.col("p_partkey")
    gene = F.concat(F.lit("g"), (key % 100).cast("string"), F.when(key % 2 == 0, ".3").otherwise(""))
    rows = T.table(spark, d, "part").select(F.col("p_brand").alias("database"), F.when(key % 9 > 0, F.col("p_type")).otherwise("").alias("term_id"), F.concat(F.lit("about "), "p_type").alias("term_name"), gene.alias("gene_id"))
    return R.read_gene_sets(spark, _table(rows))


@query("""SELECT 'c' || (o_orderkey % 3) AS chrom, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey + 1 ELSE o_orderkey END AS pos,
 'k' || o_orderkey AS source_id FROM orders WHERE o_orderkey % 4 <> 3""")
def polya_file(spark, d):
    """Rows of other features are left out; ids come from one attribute or the other."""
    key = F.col("o_orderkey")
    note = F.concat(F.when(key % 5 == 0, "gene_id").otherwise("transcript_id"), F.lit(' "k'), key.cast("string"), F.lit('";'))
    feature = F.when(key % 4 == 3, "polyA_signal").otherwise("polyA_site")
    lines = T.table(spark, d, "orders").select(
        _tabbed(F.concat(F.lit("c"), (key % 3).cast("string")), F.lit("made"), feature, key + 1, key + 2, F.lit("."), F.when(key % 2 == 0, "+").otherwise("-"), F.lit("."), note).alias("value")
    )
    return R.read_polya_gtf(spark, _text(spark.createDataFrame([("##format: gtf",)], "value string").union(lines)))


@query("""SELECT 'c:' || (o_custkey % 3) AS chrom, CASE WHEN o_custkey % 2 = 0 THEN '+' ELSE '-' END AS strand, CAST(o_custkey AS BIGINT) AS pos, CAST(count(*) AS BIGINT) AS rows
 FROM orders WHERE o_orderkey % 8 > 0 GROUP BY ALL HAVING count(*) > 1""")
def site_id_file(spark, d):
    """Places that more than one row of a site table names; contigs may hold colons, odd ids are left out."""
    key = F.col("o_custkey")
    site = F.concat(F.lit("c:"), (key % 3).cast("string"), F.lit(":"), F.when(key % 2 == 0, "+").otherwise("-"), F.lit(":"), (key + 1).cast("string"))
    rows = T.table(spark, d, "orders").select(F.when(F.col("o_orderkey") % 8 > 0, site).otherwise("none").alias("PAS_ID"), F.col("o_orderkey").alias("other"))
    return R.first_of(R.read_site_ids(spark, _table(rows)))[1]


@query("""SELECT 'x' AS sample_id, l_returnflag AS chrom, CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand, l_orderkey * 7 + l_linenumber AS pos,
 CAST(l_linenumber - 1 AS BIGINT) AS count, l_partkey % 2 = 0 AS a_rich FROM lineitem WHERE l_linenumber > 1 AND l_suppkey % 5 > 0""")
def candidate_file(spark, d):
    """Counts as decimals, one of no reads, strands that are missing, truth in several spellings."""
    odd = F.col("l_partkey") % 2 == 1
    truth = F.when(odd, F.when(F.col("l_suppkey") % 2 == 0, "False").otherwise("0")).otherwise(F.when(F.col("l_suppkey") % 2 == 0, "TRUE").otherwise("yes"))
    rows = T.table(spark, d, "lineitem").select(
        F.col("l_returnflag").alias("chrom"), F.when(F.col("l_suppkey") % 5 == 0, ".").when(F.col("l_linestatus") == "F", "+").otherwise("-").alias("strand"),
        (F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("pos"), (F.col("l_linenumber") - 1).cast("double").alias("count"), truth.alias("a_rich"),
    )
    return R.read_candidates(spark, _table(rows), "x")


@query(T.sql("""SELECT seq_id, CASE WHEN lo >= 0 AND hi <= length(sequence) THEN CASE WHEN strand = '-' THEN translate(reverse(s), 'ACGT', 'TGCA') ELSE s END END AS sequence FROM (
 SELECT *, substr(sequence, CAST(lo + 1 AS INTEGER), 30) AS s FROM (SELECT *, CASE WHEN strand = '-' THEN pos - 19 ELSE pos - 10 END AS lo, CASE WHEN strand = '-' THEN pos + 11 ELSE pos + 20 END AS hi FROM sq WHERE length(sequence) > 0))""", "sq"))
def fasta_file(spark, d):
    """Windows of 10 before and 20 from a position on, of whole sequences in lines of 60, cut to chunks of 256."""
    seqs = T.sequences(spark, d).filter("length(sequence) > 0").withColumn("chrom", F.concat(F.lit("d"), F.col("seq_id").cast("string")))
    record = F.concat(F.lit(">"), "chrom", F.lit(" made\n"), F.regexp_replace("sequence", "(.{60})", "$1\n"))
    chunks = R.read_fasta_chunks(spark, _text(seqs.select(record.alias("value"))), width=256, overlap=32)
    places = seqs.select("seq_id", "chrom", F.col("pos").cast("long").alias("pos"), "strand")
    return R.windows(places, chunks, 10, 20, width=256).select("seq_id", "sequence")


@query(T.sql("SELECT contrast_id, gene_id, round(effect, 6) AS effect FROM rs", "rs"))
def merged_fragments(spark, d):
    """Each contrast's rows are written apart and put below each other."""
    results = T.results(spark, d).select("contrast_id", "gene_id", "effect")
    parts = [_table(results.filter(F.col("contrast_id") == f"c{i}")) for i in range(3)]
    rows = W.merged([R.read_table(spark, p, results.columns) for p in parts])
    return rows.select("contrast_id", "gene_id", R.number(F.col("effect")).alias("effect")).select("contrast_id", "gene_id", *r6("effect"))


@query(T.sql("""SELECT sample_id, strand, chrom, pos AS start, pos + 1 AS "end", round(count * (1e6 / total) * CASE WHEN strand = '-' THEN -1.0 ELSE 1.0 END, 4) AS value FROM c2 JOIN tot USING (sample_id)""", "c2", "tot"))
def bedgraph_file(spark, d):
    """Tracks as text, read back by sample and strand."""
    from endweave.plans.models import bedgraph_signal

    path = _place(spark)
    W.write_bedgraph(bedgraph_signal(spark, d), path)
    f = F.split("value", "\t")
    rows = spark.read.schema("value string, sample_id string, strand string").text(path)
    return rows.select("sample_id", "strand", f[0].alias("chrom"), f[1].cast("long").alias("start"), f[2].cast("long").alias("end"), F.round(f[3].cast("double"), 4).alias("value"))


#: Contigs whose sequence is that of documents, one behind the other.
_GENOME = {
    "ctg": "SELECT (['A', 'N', 'R'])[seq_id % 3 + 1] AS chrom, string_agg(sequence, '' ORDER BY seq_id) AS s FROM sq GROUP BY 1",
    "chk": """SELECT chrom, k, greatest(k * 1000 - 20, 0) AS lo, substr(s, CAST(greatest(k * 1000 - 20, 0) + 1 AS INTEGER), CAST((k + 1) * 1000 + 20 - greatest(k * 1000 - 20, 0) AS INTEGER)) AS sequence
 FROM ctg, range(length(s) // 1000 + 1) t(k)""",
    "msk": f"""SELECT chrom, strand, p, {_MASK} AS masked FROM (SELECT pl.chrom, strand, pl.pos AS p, pl.pos - lo AS pos, sequence, CASE WHEN strand = '+' THEN 'A' ELSE 'T' END AS base
 FROM (SELECT DISTINCT chrom, strand, pos FROM en WHERE unclipped > 0) pl LEFT JOIN chk ON chk.chrom = pl.chrom AND k = pl.pos // 1000)""",
    "c1": """SELECT sample_id, en.chrom, en.strand, en.pos, unclipped AS count, coalesce(masked, false) AS masked FROM en JOIN msk ON msk.chrom = en.chrom AND msk.strand = en.strand AND msk.p = en.pos WHERE unclipped > 0""",
}


def _sequence_sql(name: str) -> str:
    """The SQL of a query with the masks by sequence in place of those by position."""
    made = f"c1 AS ({T.SQL['c1'][0]})"
    return sql_of(name).replace(made, ",\n".join(f"{k} AS ({v})" for k, v in _GENOME.items())).replace("WITH ", f"WITH sq AS ({T.SQL['sq'][0]}),\n", 1)


def _masked_study(spark, d):
    """The site pipeline with masks by sequence: ends meet chunks of 4,096 bases of a written FASTA."""
    from endweave.operators import ends as E
    from endweave.plans.core import Study

    seqs = T.sequences(spark, d)
    chrom = F.element_at(F.array(*map(F.lit, "ANR")), (F.col("seq_id") % 3 + 1).cast("int"))
    lines = seqs.select(chrom.alias("chrom"), F.col("seq_id").alias("no"), F.col("sequence").alias("value"))
    heads = lines.select("chrom").distinct().select("chrom", F.lit(-1).cast("long"), F.concat(F.lit(">"), "chrom"))
    # Lines in order, over as many files as it takes.
    ordered = lines.union(heads).repartitionByRange("chrom", "no").sortWithinPartitions("chrom", "no")
    chunks = R.read_fasta_chunks(spark, _text(ordered.select("value")), width=4096, overlap=32)
    return Study(spark, d, lambda places: E.priming_masks(places, chunks, 4096))


@query(_sequence_sql("end_audit_funnel"))
def sequence_masked_funnel(spark, d):
    from endweave.operators.qc import end_audit

    study = _masked_study(spark, d)
    return end_audit(study.ends, study.routed)


@query(_sequence_sql("active_pas"))
def sequence_masked_sites(spark, d):
    return _masked_study(spark, d).sites.select("pas_id", "chrom", "strand", "summit", "start", "end", (F.col("end") - F.col("start")).alias("actual_width"))
