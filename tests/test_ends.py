"""Hand-computed values of ends, masks, sites, genes and counts."""

import random

import pytest
from pyspark.sql import functions as F

from endweave.functions import genomics as G
from endweave.operators import assign, ends, intervals


def value(spark, column, **row):
    return spark.createDataFrame([tuple(row.values())], list(row)).select(column.alias("v")).head()["v"]


def test_centred_interval(spark):
    for pos, want in ((100, (86, 116)), (2, (0, 18)), (998, (984, 1000))):
        low, high = G.centered(F.col("p"), 30, F.lit(1000))
        assert value(spark, F.struct(low, high), p=pos) == want


def test_internal_priming(spark):
    cases = (("CCCCCAAAAAACCCCC", 7, "+", True), ("CCCCCAAAAAACCCCC", 1, "+", False), ("CCCAAACAACAAACCCC", 8, "+", True), ("CCCTTTCTTCTTTCCCC", 8, "-", True))
    for seq, pos, strand, want in cases:
        assert value(spark, G.internal_priming(F.col("s"), F.col("p").cast("int"), F.col("t")), s=seq, p=pos, t=strand) is want


def test_mapping_classes(spark):
    cases = ((1024, 1, "eligible_primary"), (0, 2, "multimapping_or_missing_NH"), (0, None, "multimapping_or_missing_NH"), (256, 1, "secondary"), (2048, 1, "supplementary"), (4, 1, "unmapped"))
    rows = spark.createDataFrame(cases, "flag int, nh int, want string")
    assert rows.filter(G.mapping_class(F.col("flag"), F.col("nh")) != F.col("want")).count() == 0


def test_ends_and_clips(spark):
    rows = [(16, 100, 150, "50M", 149, "+", False), (0, 100, 150, "50M", 100, "-", False), (0, 100, 150, "5S50M", 100, "-", True), (16, 100, 150, "50M5H", 149, "+", True), (0, 100, 150, "50M5S", 100, "-", False), (16, 100, 150, "5H50M", 149, "+", False)]
    df = spark.createDataFrame(rows, "flag int, s long, e long, cigar string, pos long, strand string, clip boolean")
    f = F.col("flag")
    same = (G.transcript_end(f, F.col("s"), F.col("e")) == F.col("pos")) & (G.transcript_strand(f) == F.col("strand")) & (G.end_clipped(f, F.col("cigar")) == F.col("clip"))
    assert df.filter(same).count() == len(rows)
    assert value(spark, G.end_clipped(F.col("f"), F.col("c"), hard=False), f=16, c="50M5H") is False


def test_exact_ends_keep_duplicates(spark):
    rows = [("s", "a", 0, "c", 100, 150, "50M", 1), ("s", "b", 1024, "c", 100, 150, "50M", 1), ("s", "c", 16, "c", 200, 250, "50M", 1)]
    df = spark.createDataFrame(rows, "sample_id string, read_name string, flag int, chrom string, ref_start long, ref_end long, cigar string, nh int")
    got = {(r.pos, r.strand, r.unclipped) for r in ends.exact_ends(df).collect()}
    assert got == {(100, "-", 2), (249, "+", 1)}


def test_threshold_and_tie(spark):
    sizes = spark.createDataFrame([("c", 1000)], "chrom string, size long")
    for strand in "+-":
        signal = spark.createDataFrame([("c", strand, 100, "31.0"), ("c", strand, 101, "31.0")], "chrom string, strand string, pos long, cpm string")
        signal = signal.withColumn("cpm", F.col("cpm").cast(ends.CPM))
        got = ends.discover_sites(signal, sizes, F.lit(30).cast(ends.CPM)).collect()
        assert [(r.summit, r.start, r.end) for r in got] == [(100, 86, 116)]
        alone = signal.filter("pos = 100").withColumn("cpm", F.lit(30).cast(ends.CPM))
        assert ends.discover_sites(alone, sizes, F.lit(30).cast(ends.CPM)).count() == 0


def test_pooled(spark):
    df = spark.createDataFrame([("s", "c", "+", 5, 1), ("s", "c", "-", 9, 1)], "sample_id string, chrom string, strand string, pos long, count long")
    assert {float(r.cpm) for r in ends.pooled_cpm(df).collect()} == {500000.0}


def test_window_sweep_against_counting(spark):
    random.seed(4)
    points = {random.randint(0, 3000): random.randint(1, 9) for _ in range(300)}
    df = spark.createDataFrame([("c", p, v) for p, v in points.items()], "chrom string, pos long, value long")
    for tile in (64, 1 << 20):
        for limit in (5, 12, 25):
            got = {(r.start, r.end) for r in intervals.window_components(df, ["chrom"], 30, F.lit(limit), tile).collect()}
            covered = set()
            for x in range(-30, 3001):
                if sum(points.get(x + i, 0) for i in range(30)) > limit:
                    covered.update(range(x, x + 30))
            want, run = set(), []
            for x in sorted(covered):
                if run and x != run[-1] + 1:
                    want.add((run[0], run[-1] + 1))
                    run = []
                run.append(x)
            if run:
                want.add((run[0], run[-1] + 1))
            assert got == want, (tile, limit)


def test_gene_assignment(spark):
    genes = spark.createDataFrame([("P", "c", "+", 100, 200), ("M", "c", "-", 300, 400)], "gene_id string, chrom string, strand string, start long, end long")
    exons = spark.createDataFrame([("P", "p", "c", "+", 190, 200), ("M", "m", "c", "-", 300, 310)], "gene_id string, transcript_id string, chrom string, strand string, start long, end long")
    sites = spark.createDataFrame([("1", "c", "+", 250), ("2", "c", "-", 250), ("3", "c", "+", 150), ("4", "c", "+", 350)], "pas_id string, chrom string, strand string, summit long")
    got = {r.pas_id: (r.gene_id, r.feature_class) for r in assign.assign_genes(sites, genes, exons, 100).collect()}
    assert got == {"1": ("P", "downstream_extension"), "2": ("M", "downstream_extension"), "3": ("P", "intron"), "4": ("", "antisense")}


def test_counts_are_disjoint(spark):
    sites = spark.createDataFrame([("a", "c", "+", 86, 116), ("b", "c", "+", 186, 216)], "pas_id string, chrom string, strand string, start long, end long")
    e = spark.createDataFrame([("s", "c", "+", 100, 3), ("s", "c", "+", 200, 4)], "sample_id string, chrom string, strand string, pos long, count long")
    samples = spark.createDataFrame([("s",), ("z",)], "sample_id string")
    got = {(r.pas_id, r.sample_id): r["count"] for r in ends.count_sites(sites, e, samples).collect()}
    assert got == {("a", "s"): 3, ("b", "s"): 4, ("a", "z"): 0, ("b", "z"): 0}
    catalog = spark.createDataFrame([("a", "G1", "unique"), ("b", "G1;G2", "ambiguous_multi_gene")], "pas_id string, gene_id string, assignment_status string")
    genes = ends.gene_counts(catalog, ends.count_sites(sites, e, samples)).collect()
    assert {(r.gene_id, r.sample_id, r["count"]) for r in genes} == {("G1", "s", 3), ("G1", "z", 0)}


def test_merge_and_overlaps_against_loops(spark):
    random.seed(5)
    spans = [(random.randint(0, 500), random.randint(0, 40)) for _ in range(80)]
    df = spark.createDataFrame([("c", i, s, s + n) for i, (s, n) in enumerate(spans)], "chrom string, i int, start long, end long")
    for adjacent in (True, False):
        merged = []
        for s, e in sorted((s, s + n) for s, n in spans if n):
            if merged and (s <= merged[-1][1] if adjacent else s < merged[-1][1]):
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        got = sorted([r.start, r.end] for r in intervals.merge(df, ["chrom"], adjacent).collect())
        assert got == merged
    pairs = {(r.i, r.o_i) for r in intervals.overlaps(df, df, ["chrom"], width=16).collect()}
    want = {(i, j) for i, (a, n) in enumerate(spans) for j, (b, m) in enumerate(spans) if a < b + m and b < a + n}
    assert pairs == want


def swept_rows(seed):
    """Intervals on contigs and strands, some of them null, some without a start or an end."""
    rng = random.Random(seed)
    rows = []
    for _ in range(260):
        a = rng.randrange(900)
        start, end = rng.choice([a] * 12 + [None]), a + rng.choice([0, 1, 3, 40, 200])
        rows.append((rng.choice(["c", "c", "d", None]), rng.choice(["+", "-", None]), start, rng.choice([end] * 12 + [None])))
    return rows


def grouped(rows):
    groups = {}
    for chrom, strand, *rest in rows:
        groups.setdefault((chrom, strand), []).append(rest)
    return groups


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("tile", [7, 64, intervals.TILE])
def test_sweeps_against_loops(spark, tile):
    """Merging, coverage, gap clusters, distances and numbers, with null keys and null positions."""
    rows, keys = swept_rows(7), ["chrom", "strand"]
    df = spark.createDataFrame(rows, "chrom string, strand string, start long, end long").repartition(3)
    for adjacent in (True, False):
        islands = []
        for (c, s), spans in grouped(rows).items():
            last = None
            for a, b in sorted(x for x in spans if None not in x and x[1] > x[0]):
                if last is not None and (a <= last[3] if adjacent else a < last[3]):
                    last[3], last[4] = max(last[3], b), last[4] + 1
                else:
                    last = [c, s, a, b, 1]
                    islands.append(last)
        assert as_rows(intervals.merge(df, keys, adjacent, tile=tile)) == sorted(map(tuple, islands), key=repr)

    depths = []
    for (c, s), spans in grouped(rows).items():
        whole = [x for x in spans if None not in x]
        steps = sorted({x for span in whole for x in span})
        runs = [[a, b, sum(i <= a < j for i, j in whole)] for a, b in zip(steps, steps[1:], strict=False)]
        joined = []
        for run in runs:
            if joined and joined[-1][2] == run[2] and joined[-1][1] == run[0]:
                joined[-1][1] = run[1]
            else:
                joined.append(run)
        depths += [(c, s, *run) for run in joined if run[2]]
    assert as_rows(intervals.coverage(df, keys, tile=tile)) == sorted(depths, key=repr)

    clusters = {}
    for key, spans in grouped(rows).items():
        number, before = 0, None
        for a in sorted((x[0] for x in spans), key=lambda a: (a is not None, a)):
            number += before is not None and a is not None and a - before > 2
            clusters.setdefault((*key, number), []).append(a)
            before = a if a is not None else before
    points = df.select(*keys, F.col("start").alias("pos"))
    got = {}
    for r in intervals.gap_clusters(points, keys, "pos", 2, tile=tile).collect():
        got.setdefault((r.chrom, r.strand, r.cluster), []).append(r.pos)
    order = lambda xs: sorted(xs, key=lambda a: (a is not None, a))
    assert {k: order(v) for k, v in got.items()} == {k: order(v) for k, v in clusters.items()}

    sites = [(c, s, end) for c, s, _, end in rows[::20]]
    held = grouped(sites)
    want = []
    for c, s, start, _ in rows:
        near = [abs(start - e) for (e,) in held.get((c, s), []) if e is not None and start is not None]
        want.append((c, s, start, min(near) if near else None))
    known = spark.createDataFrame(sites, "chrom string, strand string, site long")
    assert as_rows(intervals.nearest_distance(points, known, keys, tile=tile)) == sorted(want, key=repr)

    named = df.distinct().withColumn("summit", F.col("end"))
    low = lambda r: tuple((x is not None, x) for x in (r[0], r[2], r[1], r[3]))
    want = [(*r, r[3], f"PAS_{i + 1:08d}") for i, r in enumerate(sorted(set(rows), key=low))]
    assert as_rows(ends.numbered(named, tile=tile)) == sorted(want, key=repr)


def test_sites_must_be_apart(spark):
    rows = [("c", "+", 5, 0, 10), ("c", "+", 15, 9, 20), ("c", "-", 5, 0, 10)]
    df = spark.createDataFrame(rows, "chrom string, strand string, summit long, start long, end long")
    assert ends.disjoint(df.filter("start = 0")).count() == 2
    with pytest.raises(Exception, match="overlap"):
        ends.disjoint(df).collect()


def test_masks_of_places_by_chunks(spark, tmp_path):
    """Every position of two contigs, at any border of chunks, against the whole sequence."""
    from endweave.functions import genomics as G
    from endweave.sources import readers

    rng = random.Random(8)
    seqs = {c: "".join(rng.choices("AT" * 3 + "CG", k=n)) for c, n in (("c", 700), ("d", 95))}
    path = tmp_path / "g.fa"
    path.write_text("".join(f">{c} x\n" + "\n".join(s[i : i + 31] for i in range(0, len(s), 31)) + "\n" for c, s in seqs.items()))
    places = spark.createDataFrame([(c, strand, p) for c in ("c", "d", "e") for strand in "+-" for p in range(720) if c != "d" or p < 120] * 2, "chrom string, strand string, pos long")
    got = {(r.chrom, r.strand, r.pos): r.masked for r in ends.priming_masks(places, readers.read_fasta_chunks(spark, str(path), 64, 16), 64).collect()}
    rows = [(c, s, strand, p) for c, s in seqs.items() for strand in "+-" for p in range(len(s))]
    whole = spark.createDataFrame(rows, "chrom string, sequence string, strand string, pos int")
    want = {(r.chrom, r.strand, r.pos): r.m for r in whole.select("chrom", "strand", "pos", G.internal_priming(F.col("sequence"), F.col("pos"), F.col("strand")).alias("m")).collect()}
    assert {k: v for k, v in got.items() if k in want} == want and 0 < sum(want.values()) < len(want)
    assert len(got) == 2 * (720 + 120 + 720) and not any(v for k, v in got.items() if k not in want)


def test_sites_read_the_signal_three_times(spark):
    """Once for the windows and once for each round of summits, however often a merge sweeps what they find."""
    read = spark.sparkContext.accumulator(0)

    def told(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [("c", "+", 200 * i + j, 10 + j) for i in range(40) for j in range(5)]
    signal = spark.createDataFrame(rows, "chrom string, strand string, pos long, cpm long").mapInArrow(told, "chrom string, strand string, pos long, cpm long")
    sizes = spark.createDataFrame([("c", 10**6)], "chrom string, size long")
    assert ends.numbered(ends.discover_sites(signal, sizes, F.lit(20))).count() == 40
    assert read.value <= 4 * len(rows)  # the last round feeds the numbers of tiles as well


def test_summits_and_windows_sort_by_numbers(spark):
    """Signal meets components without a sort of its positions, strips of windows are sorted by their numbers
    before contigs; summits are those of a loop, the lowest of ties on both sides of a bin's edge too."""
    rng = random.Random(4)
    signal = {(c, s, p): rng.choice([1, 2, 3, 3]) for c in "ab" for s in "+-" for p in rng.sample(range(900, 5000), 1500)}
    parts = [(c, s, a, a + rng.choice([5, 40, 700])) for c in "ab" for s in "+-" for a in range(950, 4900, 150)]
    sizes = spark.createDataFrame([("a", 10**6), ("b", 10**6)], "chrom string, size long")
    pooled = spark.createDataFrame([(*k, v) for k, v in signal.items()], "chrom string, strand string, pos long, cpm long")
    told = spark.createDataFrame(parts, "chrom string, strand string, start long, end long")
    expected = []
    for c, s, a, b in parts:
        inside = [(-v, p) for (x, y, p), v in signal.items() if (x, y) == (c, s) and a <= p < b]
        expected += [(c, s, min(inside)[1])] if inside else []
    for cpm in (F.col("cpm"), (F.col("cpm") / 4).cast(ends.CPM)):
        found = ends.recenter(told, pooled.withColumn("cpm", cpm), sizes, 30)
        assert sorted((r.chrom, r.strand, r.summit) for r in found.collect()) == sorted(expected)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan.split("ShuffledHashJoin")[1]
    swept = []
    keep = intervals.cut
    try:
        intervals.cut = lambda df: (swept.append(df._jdf.queryExecution().executedPlan().toString()), keep(df))[1]
        intervals.window_components(pooled.withColumnRenamed("cpm", "value"), ["chrom", "strand"], 30, F.lit(5)).count()
    finally:
        intervals.cut = keep
    assert "Sort [tile#" in swept[0] and "HashAggregate(keys=[chrom" not in swept[0]


def test_pooled_values_of_small_and_large_counts(spark):
    """Values that are looked up and those worked out for a row are the same."""
    rows = [(f"s{i % 3}", "c", "+", i, n) for i, n in enumerate([0, 1, 2, 254, 255, 256, 257, 10**6, 3])]
    total = {f"s{k}": sum(r[4] for r in rows if r[0] == f"s{k}") for k in range(3)}
    got = {r.pos: r.cpm for r in ends.pooled_signal(spark.createDataFrame(rows, "sample_id string, chrom string, strand string, pos long, count long")).collect()}
    assert got == {p: round(round(n * 1e6 / total[s], 6) * 1e6) for s, _, _, p, n in rows}


def test_windows_sweep_a_row_a_point(spark):
    """Windows are those of a count at every place, with several contigs, ties and tiles that cut them; points are
    not made two events each."""
    rng = random.Random(9)
    points = [(c, p, rng.choice([0, 1, 2, 9])) for c in "ab" for p in (rng.randrange(-100, 900) for _ in range(260))]
    df = spark.createDataFrame(points, "chrom string, pos long, value long")
    plans, keep = [], intervals.cut
    for tile, limit in ((32, 6), (64, 12), (1 << 12, 20)):
        try:
            intervals.cut = lambda d: (plans.append(d._jdf.queryExecution().executedPlan().toString()), keep(d))[1]
            got = {tuple(r) for r in intervals.window_components(df, ["chrom"], 30, F.lit(limit), tile).select("chrom", "start", "end").collect()}
        finally:
            intervals.cut = keep
        want = set()
        for c in "ab":
            covered = set()
            for x in range(-140, 901):
                if sum(v for k, p, v in points if k == c and x <= p < x + 30) > limit:
                    covered.update(range(x, x + 30))
            starts, stops = sorted(x for x in covered if x - 1 not in covered), sorted(x + 1 for x in covered if x + 1 not in covered)
            want |= {(c, a, b) for a, b in zip(starts, stops)}
        assert got == want, (tile, limit)
    assert not any("explode(array(" in plan for plan in plans)


def test_only_masked_ends_are_written_again(spark):
    """Ends of C2 that are not masked are read where the exact ends lie."""
    from endweave.plans import core

    rows, keep = [], core.written
    study = core.Study(spark, "/root/testdata/sf0.001")
    masked = study.c1.filter("masked").count()
    whole = study.routed.filter("universe = 'C2'").select("sample_id", *core.PLACE, "pos", "count").collect()
    try:
        core.written = lambda df: (rows.append(df.count()), keep(df))[1]
        got = study.c2.collect()
    finally:
        core.written = keep
    assert sorted(map(tuple, got)) == sorted(map(tuple, whole))
    assert sum(rows) <= masked


def test_dropped_ends_are_found_among_masked_ones(spark, monkeypatch):
    """C2R is what all ends routed leave, and track_scales looks for known sites of masked ends alone."""
    from endweave.plans import core, models

    study = core.Study(spark, "/root/testdata/sf0.001")
    whole = study.routed.filter("universe = 'C2R'").select("sample_id", *core.PLACE, "pos", "count").collect()
    assert sorted(map(tuple, study.dropped.collect())) == sorted(map(tuple, whole)) != []
    monkeypatch.delattr(core.Study, "routed")
    assert models.track_scales(spark, "/root/testdata/sf0.001").filter("family = 'C2R'").count() == 6


def test_summits_come_with_the_windows(spark):
    """Components and summits of one sweep are those of two, with several rows a place, ties, null keys and tiles
    that cut them, and signal moves once."""
    rng = random.Random(12)
    rows = [(c, s, rng.randrange(-80, 900), rng.choice([0, 1, 1, 2, 9])) for c in ("a", "b", None) for s in "+-" for _ in range(330)]
    df = spark.createDataFrame(rows, "chrom string, strand string, pos long, value long")
    placed = {}
    for c, s, p, v in rows:
        placed[c, s, p] = placed.get((c, s, p), 0) + v
    for tile, limit in ((32, 9), (64, 14), (1 << 14, 25)):
        got = {tuple(r) for r in intervals.window_summits(df, ["chrom", "strand"], 30, F.lit(limit), tile, 128).collect()}
        want = set()
        for c, s, a, b in map(tuple, intervals.window_components(df, ["chrom", "strand"], 30, F.lit(limit)).collect()):
            want.add((c, s, a, b, min((-v, p) for (x, y, p), v in placed.items() if (x, y) == (c, s) and a <= p < b)[1]))
        assert got == want and want, (tile, limit)


def test_signal_moves_once(spark):
    """Windows, both rounds of summits and counts deal the rows of C2 out once."""
    from endweave.plans import core

    study = core.Study(spark, "/root/testdata/sf0.01")
    ends_ = study.c2.count()
    study.threshold
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    stages = lambda: (lambda found: {found.apply(i).stageId(): found.apply(i).shuffleWriteRecords() for i in range(found.size())})(store.stageList(None, False, False, none, None))
    before = stages()
    assert study.counts.count() == 6 * study.sites.count()
    assert sum(n > 0.8 * ends_ for i, n in stages().items() if i not in before) == 1


def test_many_sites_are_dealt_out(spark, monkeypatch):
    """Sites beyond what is handed to every task give the same counts."""
    from endweave import session

    sites = spark.createDataFrame([(str(i), "c", "+", 50 * i, 50 * i + 30) for i in range(40)], "pas_id string, chrom string, strand string, start long, end long")
    rng = random.Random(3)
    rows = [("s", "c", "+", p, 1 + p % 3) for p in rng.sample(range(2200), 900)]
    df = spark.createDataFrame(rows, "sample_id string, chrom string, strand string, pos long, count long")
    samples = spark.createDataFrame([("s",)], "sample_id string")
    want = {str(i): sum(r[4] for r in rows if 50 * i <= r[3] < 50 * i + 30) for i in range(40)}
    for most in (session.NEAR_ROWS, 0):
        monkeypatch.setattr(session, "NEAR_ROWS", most)
        assert {r.pas_id: r["count"] for r in ends.count_sites(sites, df, samples).collect()} == want
