"""Readers, writers, settings and streams on small files."""

import os
import random

import pytest
from pyspark.sql import functions as F

from endweave.sources import readers, writers
from endweave.sources.settings import SettingsError, parse_settings
from endweave.streaming import status


def put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_settings():
    s = parse_settings('# a\nPROJECT_ID="p1"\nFDR=0.1  # b\nRUN_USAGE=false\n')
    assert (s.project_id, s.fdr, s.run_usage) == ("p1", 0.1, False)
    for text in ("PROJECT_ID=a\nPROJECT_ID=b", "PROJECT_ID=a\nNOPE=1", "PROJECT_ID=$(ls)", "FDR=0.1", "PROJECT_ID=a\nFDR=x", "PROJECT_ID=a\nWINDOW=20", "project_id=a"):
        with pytest.raises(SettingsError):
            parse_settings(text)


def test_gtf_and_bed(spark, tmp_path):
    gtf = put(tmp_path, "a.gtf", '#c\nc\ts\tgene\t101\t200\t.\t+\t.\tgene_id "G"; gene_type "x"; tag "a"; tag "b";\nc\ts\ttranscript\t101\t200\t.\t-\t.\tgene_id "G"; transcript_id "T";\n')
    rows = readers.read_gtf(spark, gtf)
    r = rows.filter("feature = 'gene'").head()
    assert (r.start, r.end, r.gene_id, r.biotype) == (100, 200, "G", "x")
    assert {(x.strand, x.site) for x in readers.transcript_ends(rows).collect()} == {("+", 199), ("-", 100)}
    bed = put(tmp_path, "a.bed", "track x\nc\t5\t6\tn\t0\t+\nc\t7\t8\n")
    assert {(x.start, x.strand) for x in readers.read_bed(spark, bed).collect()} == {(5, "+"), (7, ".")}
    sizes = put(tmp_path, "sizes", "#x\nc 100\nd\t0\n")
    assert [tuple(x) for x in readers.read_sizes(spark, sizes).collect()] == [("c", 100)]


def test_alignments(spark, tmp_path):
    sam = put(tmp_path, "a.sam", "@HD\nr1\t16\tc\t101\t60\t5S10M5N10M\t*\t0\t0\t*\t*\tNH:i:1\nr2\t0\tc\t11\t60\t10M2D3M\t*\t0\t0\t*\t*\n")
    rows = readers.read_alignments(spark, sam, "s")
    got = {r.read_name: (r.ref_start, r.ref_end, r.nh) for r in rows.collect()}
    assert got == {"r1": (100, 125, 1), "r2": (10, 25, None)}
    blocks = {(r.read_name, r.start, r.end) for r in readers.aligned_blocks(rows).collect()}
    assert blocks == {("r1", 100, 110), ("r1", 115, 125), ("r2", 10, 25)}


def test_fasta_windows(spark, tmp_path):
    seq = "ACGTTGCAACGGTTAACCGGTACGTTAGC" * 3
    fasta = put(tmp_path, "a.fa", ">c one\n" + "\n".join(seq[i : i + 10] for i in range(0, len(seq), 10)) + "\n>d\nACGT\n")
    chunks = readers.read_fasta_chunks(spark, fasta, width=16, overlap=12)
    places = spark.createDataFrame([("c", "+", 20), ("c", "-", 40), ("c", "+", 2), ("d", "+", 3)], "chrom string, strand string, pos long")
    got = {(r.chrom, r.strand, r.pos): r.sequence for r in readers.windows(places, chunks, 5, 6, width=16).collect()}
    back = seq[35:46][::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert got == {("c", "+", 20): seq[15:26], ("c", "-", 40): back, ("c", "+", 2): None, ("d", "+", 3): None}


def test_fasta_over_files_and_splits(spark, tmp_path):
    """A record that goes on over splits and files, long lines, headers at either side of a border."""
    rng = random.Random(3)
    seqs = {f"c{i}": "".join(rng.choices("ACGT", k=n)) for i, n in enumerate((900, 1, 57, 2500, 64))}
    lines = ["lost"]
    for name, s in seqs.items():
        step = 700 if name == "c3" else 31
        lines += [f">{name} made", *[s[i : i + step].lower() for i in range(0, len(s), step)]]
    for at, (a, b) in enumerate([(0, 9), (9, 20), (20, 33), (33, len(lines))]):
        (tmp_path / "f").mkdir(exist_ok=True)
        (tmp_path / "f" / f"part-{at}.fa").write_text("\n".join(lines[a:b]) + "\n")
    held = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = {(r.chrom, r.chunk): (r.offset, r.sequence) for r in readers.read_fasta_chunks(spark, str(tmp_path / "f"), width=64, overlap=16).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held[0])
        spark.conf.set("spark.sql.files.openCostInBytes", held[1])
    want = {(c, k): (max(0, k * 64 - 16), s[max(0, k * 64 - 16) : (k + 1) * 64 + 16]) for c, s in seqs.items() for k in range((len(s) + 63) // 64)}
    assert got == want


def test_tables(spark, tmp_path):
    ends = put(tmp_path, "e.tsv", "chrom\tstart\tend\tstrand\tcount\nc\t5\t6\t+\t2\nc\t5\t6\t+\t3\nc\t7\t8\t.\t1\nc\t9\t10\t-\t0\n")
    assert [tuple(r) for r in readers.read_positions(spark, ends).collect()] == [("c", "+", 5, 5)]
    matrix = put(tmp_path, "m.tsv", "gene_id\ta\tb\nG\t1\t2.0\n")
    assert {(r.sample_id, r["count"]) for r in readers.read_matrix(spark, matrix, "gene_id", ["a", "b"]).collect()} == {("a", 1), ("b", 2)}
    wrong = put(tmp_path, "w.tsv", "gene_id\ta\nG\t1.5\n")
    with pytest.raises(Exception, match="no count"):
        readers.read_matrix(spark, wrong, "gene_id", ["a"]).collect()
    ids = put(tmp_path, "i.tsv", "PAS_ID\tGene\nchr1:-:11\tx\nchr2:+:21\ty\nbad\tz\n")
    assert {(r.chrom, r.pos, r.strand) for r in readers.read_site_ids(spark, ids).collect()} == {("chr1", 10, "-"), ("chr2", 20, "+")}


def test_reports(spark, tmp_path):
    log = put(tmp_path, "Log.final.out", " Uniquely mapped reads % |\t80.00%\n junk\n")
    assert [(r.key, r.value) for r in readers.read_key_values(spark, log).collect()] == [("Uniquely mapped reads %", "80.00%")]
    infer = put(tmp_path, "infer.txt", 'Fraction of reads failed to determine: 0.02\nFraction of reads explained by "++,--": 0.05\nFraction of reads explained by "+-,-+": 0.93\n')
    r = readers.read_orientation(spark, infer).head()
    assert (r.undetermined, r.forward, r.reverse, r.dominant) == (0.02, 0.05, 0.93, "reverse")
    sheet = put(tmp_path, "s.csv", ",".join(readers.SHEET) + "\n" + ",".join(["s1", "d", "hg38", "1", "1", "L1", "f1", "", "A", "b", "u", "p", "SE", "75", "k", "no"]) + "\n" + ",".join(["s1", "d", "GRCh38", "1", "1", "L1", "f1", "", "B", "b", "u", "p", "SE", "75", "k", "no"]) + "\n")
    rows = readers.read_sample_sheet(spark, sheet)
    assert {r.genome for r in rows.collect()} == {"GRCh38"}
    assert {r.fault for r in readers.sheet_faults(rows).collect()} == {"repeated_lane", "repeated_file", "inconsistent_sample"}
    texts = spark.createDataFrame([("NA",), ("",), ("NaN",), ("Infinity",), ("1.5",)], "t string")
    assert [r.v for r in texts.select(readers.number(F.col("t")).alias("v")).collect()] == [None] * 4 + [1.5]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("G", "c", 0, 10, "+"), ("H", "c", 20, 30, "-")], "gene_id string, chrom string, start long, end long, strand string")
    assert [r.Start for r in writers.as_saf(df).collect()] == [1, 21]
    out = str(tmp_path / "bed")
    writers.write_bed(writers.as_bed(df), out)
    assert readers.read_bed(spark, out).count() == 2
    assert writers.content_digest(df) == writers.content_digest(df.orderBy(F.col("start").desc()).repartition(3))
    key = writers.signature({"a": 1}, {"x": "y"})
    manifest = writers.receipt(df, "step", key)
    assert writers.still_valid(manifest, "step", key, df) and not writers.still_valid(manifest, "step", key, df.limit(1))
    with pytest.raises(ValueError):
        writers.merged([df, df.drop("strand")])
    signal = spark.createDataFrame([("s", "+", 1, "c", 5, 6, 0.1)], "sample_id string, strand string, ordinal int, chrom string, start long, end long, value double")
    writers.write_bedgraph(signal, str(tmp_path / "bg"))
    assert [r.value for r in spark.read.text(str(tmp_path / "bg")).collect()] == ["c\t5\t6\t0.1"]


def test_stream_gives_what_the_batch_gives(spark, tmp_path):
    rows = [(i, f"2024-01-01 0{i % 5}:00:00", i % 3, "ab"[i % 2], 1.0, "{}") for i in range(40)]
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string").withColumn("ts", F.to_timestamp("ts"))
    folder = str(tmp_path / "events")
    df.repartition(3).write.parquet(folder)
    events = status.read_events(spark, folder)
    for name, made, mode in (("status_t", status.status_updates(events), "complete"), ("window_t", status.counts_per_window(events), "append"), ("session_t", status.sessions(events), "append")):
        run = made.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        run.awaitTermination(120)
        assert run.exception() is None
    batch = {(r.event_type, r.last_event, r.events) for r in status.status_updates(df).collect()}
    assert {(r.event_type, r.last_event, r.events) for r in spark.table("status_t").collect()} == batch


def _bam(reads):
    import struct
    import zlib

    names = ["c", "d"]
    head = b"BAM\x01" + struct.pack("<i", 4) + b"@HD\n" + struct.pack("<i", len(names))
    for n in names:
        head += struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", 1000)
    body = head
    for name, flag, contig, pos, ops, tags in reads:
        r = struct.pack("<iiBBHHHiiii", contig, pos, len(name) + 1, 60, 0, len(ops), flag, 5, -1, -1, 0) + name.encode() + b"\0"
        r += b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(k)) for n, k in ops) + b"\x11" * 3 + b"\xff" * 5 + tags
        body += struct.pack("<i", len(r)) + r
    out = b""
    for i in range(0, len(body), 50):  # records cross the borders of blocks
        z = zlib.compressobj(wbits=31)
        out += z.compress(body[i : i + 50]) + z.flush()
    return out


def test_binary_alignments(spark, tmp_path):
    import struct

    reads = [
        ("r1", 16, 0, 100, [(5, "S"), (10, "M"), (5, "N"), (10, "M")], b"XAZab\0" + b"BBBs" + struct.pack("<ihh", 2, 1, 2) + b"NHC\x01"),
        ("r2", 4, -1, -1, [], b""),
        ("r3", 0, 1, 10, [(10, "M"), (2, "D"), (3, "M"), (1, "I")], b"NHi" + struct.pack("<i", 7)),
    ]
    path = tmp_path / "a.bam"
    path.write_bytes(_bam(reads))
    got = [tuple(r) for r in readers.read_bam(spark, str(path), "s").collect()]
    assert got == [("s", "r1", 16, "c", 100, 125, "5S10M5N10M", 1), ("s", "r2", 4, "*", -1, -1, "*", None), ("s", "r3", 0, "d", 10, 25, "10M2D3M1I", 7)]
    assert readers.read_bam(spark, str(path), "s").columns == readers.read_alignments(spark, put(tmp_path, "b.sam", "@HD\n"), "s").columns
    path.write_bytes(_bam(reads)[:-30])
    with pytest.raises(Exception, match="ends inside"):
        readers.read_bam(spark, str(path), "s").collect()


def test_binary_alignments_in_ranges(spark, tmp_path):
    """Any size of ranges gives the same rows; a file has several; records cross blocks and ranges."""
    from endweave.sources import bam, writers

    rng = random.Random(3)
    rows = []
    for i in range(6000):
        mapped = rng.random() < 0.95
        cigar = "".join(f"{rng.randint(1, 300)}{k}" for k in rng.choice(["M", "SM", "MNM", "MIMDMS", "HMX=" * 40])) if mapped else "*"
        rows.append((f"read{i}{'x' * rng.randint(0, 90)}", rng.choice([0, 16, 4, 1024]), rng.choice(["c", "d"]) if mapped else "*", rng.randint(0, 10**6) if mapped else -1, cigar, rng.choice([None, 1, 2, 300])))
    df = spark.createDataFrame(rows, "read_name string, flag int, chrom string, ref_start long, cigar string, nh int")
    folder = str(tmp_path / "out")
    writers.write_bam(df.coalesce(1), folder, [("c", 2 * 10**6), ("d", 2 * 10**6)])
    (name,) = [x for x in os.listdir(folder) if not x.startswith((".", "_"))]
    size = os.path.getsize(f"{folder}/{name}")
    assert size > 3 * 0x8000
    for split in (997, 20_011, 65_536, size * 2):
        got = [r for part in bam.ranged(f"{folder}/{name}", split) for r in bam.read_range(part)]
        assert [(r[0], r[1], r[2], r[3], r[5], r[6]) for r in got] == rows
    back = readers.read_bam(spark, folder, "s", 30_000)
    assert back.rdd.getNumPartitions() >= 4
    assert sorted((r.read_name, r.flag, r.chrom, r.ref_start, r.cigar, r.nh) for r in back.collect()) == sorted(rows, key=lambda r: r[0])
    assert all(r.ref_end == r.ref_start + sum(int(n) for n, k in bam._cut(r.cigar) if k in "MDN=X") for r in back.collect() if r.cigar != "*")
    writers.write_bam(df.limit(0), str(tmp_path / "none"), [("c", 9)])
    assert readers.read_bam(spark, str(tmp_path / "none"), "s").count() == 0


def test_chains(spark, tmp_path):
    """Every base of made chains, both strands and with gaps, against a walk through the lines."""
    from endweave.operators import atlas, liftover

    rng = random.Random(4)
    text, where = "#made up\n", {}
    for i in range(12):
        chrom, at, to, strand = rng.choice("cd"), rng.randint(0, 400), rng.randint(0, 900), rng.choice("+-")
        lines, a, q = [], at, to
        for last in [False] * rng.randint(0, 4) + [True]:
            size, gap, to_gap = rng.randint(1, 40), rng.randint(0, 9), rng.randint(0, 9)
            for k in range(size):
                where.setdefault((chrom, a + k), []).append((f"q{i % 3}", 5000 - 1 - (q + k) if strand == "-" else q + k, strand, str(i)))
            a, q = a + size + (0 if last else gap), q + size + (0 if last else to_gap)
            lines.append(f"{size}" if last else f"{size}\t{gap} {to_gap}")
        text += f"chain 5 {chrom} 9000 + {at} {a} q{i % 3} 5000 {strand} {to} {q} {i}\n" + "\n".join(lines) + "\n\n"
    path = put(tmp_path, "a.chain", text)
    rows = [(f"{c}{p}{s}", c, s, p) for c in "cde" for p in range(0, 700, 3) for s in "+-"]
    df = spark.createDataFrame(rows, "source_id string, chrom string, strand string, pos long")
    found = liftover.hits(df, readers.read_chains(spark, path))
    flip = {"+": "-", "-": "+"}
    want = sorted((i, to, q, s if strand == "+" else flip[s], chain) for i, c, s, p in rows for to, q, strand, chain in where.get((c, p), []))
    assert sorted(map(tuple, found.collect())) == want
    got = {r.source_id: r.status for r in atlas.lifted(df, found).collect()}
    for i, c, _, p in rows:
        told = where.get((c, p), [])
        assert got[i] == ("unmapped" if not told else "multiple" if len(told) > 1 else "strand_changed" if told[0][2] == "-" else "lifted")
    for wrong in ("chain 5 c 90 + 0 11 q 50 + 0 10 1\n10\n", "track x\n"):
        with pytest.raises(Exception, match="chain"):
            readers.read_chains(spark, put(tmp_path, "b.chain", wrong)).collect()


def test_polya_sites(spark, tmp_path):
    import zipfile

    row = lambda f, a, b, s, name: f'c\ts\t{f}\t{a}\t{b}\t.\t{s}\t.\ttranscript_id "{name}";\n'
    gtf = put(tmp_path, "p.gtf", "#x\n" + row("polyA_site", 9, 10, "+", "one") + row("polyA_signal", 1, 2, "+", "no") + row("polyA_site", 8, 10, "+", "two") + row("polyA_site", 5, 7, "-", "m") + "short\n")
    assert {tuple(r) for r in readers.read_polya_gtf(spark, gtf).collect()} == {("c", "+", 9, "one"), ("c", "-", 4, "m")}
    assert {tuple(r) for r in readers.polya_features(spark, gtf).collect()} == {("polyA_site", 3), ("polyA_signal", 1)}
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/readme", "no")
        z.writestr("x/sites.tsv", "PAS_ID\tn\nchr1:a:+:10\t1\nchr1:a:+:10\t2\nbad\t3\nchr2:-:5\t4\n")
    sites = readers.read_zipped_site_ids(spark, str(tmp_path / "a.zip"), "sites.tsv")
    once, repeated = readers.first_of(sites)
    assert {tuple(r)[:3] for r in once.collect()} == {("chr1:a", "+", 9), ("chr2", "-", 4)}
    assert [tuple(r) for r in repeated.collect()] == [("chr1:a", "+", 9, 2)]


def test_candidates_gene_sets_and_models(spark, tmp_path):
    path = put(tmp_path, "c.tsv", "chrom\tstrand\tpos\tcount\ta_rich\nc\t+\t5\t3.0\tTRUE\nc\t.\t6\t3\t0\nc\t-\t7\t0.5\tyes\nc\t-\t8\tNA\tno\nc\t-\t9\t2\t\n")
    assert [tuple(r) for r in readers.read_candidates(spark, path, "s").collect()] == [("s", "c", "+", 5, 3, True), ("s", "c", "-", 9, 2, False)]
    sets = put(tmp_path, "g.tsv", "database\tterm_id\tterm_name\tgene_id\nH\tt\tT\tE1.4\nH\tt\tT\tE1.5\nR\tu\tU\tE2\nH\t\tx\tE3\n")
    assert {tuple(r) for r in readers.read_gene_sets(spark, sets).collect()} == {("H", "t", "T", "E1"), ("R", "u", "U", "E2")}
    assert readers.read_gene_sets(spark, sets, ["R"]).count() == 1
    rows = [("g", "c", "+", 0, 10, "exon", "b"), ("h", "c", "+", 90, 120, "exon", "b"), ("h", "c", "-", 1, 2, "exon", "x"), ("i", "z", "+", 0, 5, "gene", "b")]
    gtf = spark.createDataFrame(rows, "gene_id string, chrom string, strand string, start long, end long, feature string, biotype string")
    sizes = spark.createDataFrame([("c", 100)], "chrom string, size long")
    assert {tuple(r) for r in readers.model_faults(gtf, sizes).collect()} == {("h", "out_of_bounds"), ("h", "several_strands"), ("h", "several_biotypes"), ("i", "unknown_contig"), ("i", "no_exon")}


def test_digest_tells_nulls_apart(spark, tmp_path):
    one, two = (spark.createDataFrame([r], "a string, b string") for r in ((None, "x"), ("x", None)))
    assert writers.content_digest(one) != writers.content_digest(two)
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder, "a.txt", "1")
    before = writers.folder_digest(spark, str(folder))
    assert before == writers.folder_digest(spark, str(folder))
    put(folder, "a.txt", "12")
    assert before != writers.folder_digest(spark, str(folder))


def test_binary_queries_write_with_all_tasks(spark, monkeypatch):
    from endweave.plans import files

    seen = []
    write = files.W.write_bam
    monkeypatch.setattr(files.W, "write_bam", lambda df, *rest: (seen.append(df.rdd.getNumPartitions()), write(df, *rest)))
    df = spark.range(400).selectExpr("concat('r', id) as read_name", "0 as flag", "'A' as chrom", "id as ref_start", "id + 30 as ref_end", "'30M' as cigar", "1 as nh").repartition(5)
    assert files._binary(spark, df).count() == 400 and seen == [5]


def test_positions_of_a_sample_in_several_files(spark, tmp_path):
    df = spark.range(4000).selectExpr("'s' as sample_id", "'c' as chrom", "'+' as strand", "id as pos", "1 as unclipped")
    held = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        writers.write_positions(df, str(tmp_path / "p"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", held)
    names = [n for n in os.listdir(tmp_path / "p" / "sample_id=s") if n.endswith(".parquet")]
    assert len(names) > 1 and spark.read.parquet(str(tmp_path / "p")).distinct().count() == 4000
