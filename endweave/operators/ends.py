"""From alignments to exact transcript ends, audits, pooled signal, active sites and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from endweave.functions import genomics as G
from endweave.operators.intervals import FINE, SITE, TILE, merge, points_in, tiled, window_summits
from endweave.session import nearby, written

PLACE = ["chrom", "strand"]
CPM = "decimal(28,6)"
#: The largest count whose value is worked out for each sample beforehand.
LOOKED_UP = 255
#: The flag of reads that are marked as duplicates.
DUPLICATE = 1024


def exact_ends(alignments: DataFrame) -> DataFrame:
    """(sample_id, chrom, strand, pos, unclipped, clipped) counts of the eligible reads' ends."""
    reads = alignments.filter(G.is_c0(F.col("flag"), F.col("nh"))).select(
        "sample_id",
        "chrom",
        G.transcript_strand(F.col("flag")).alias("strand"),
        G.transcript_end(F.col("flag"), F.col("ref_start"), F.col("ref_end")).alias("pos"),
        G.end_clipped(F.col("flag"), F.col("cigar")).alias("clip"),
    )
    # Nearly every row is a group: sums of numbers cost less than counts of conditions.
    ones = reads.select("sample_id", *PLACE, "pos", *[F.coalesce(c.cast("long"), F.lit(0)).alias(n) for n, c in (("unclipped", ~F.col("clip")), ("clipped", F.col("clip")))])
    return ones.groupBy("sample_id", *PLACE, "pos").agg(F.sum("unclipped").alias("unclipped"), F.sum("clipped").alias("clipped"))


def endpoint_reads(alignments: DataFrame, layout: str = "SE") -> DataFrame:
    """Reads (chrom, strand, pos, eligible, duplicate, clipped, defining) of a layout, whatever their number
    of hits: a mate that defines no end is none of the others, an eligible read is mapped and primary."""
    flag = F.col("flag")
    defining = G.defines_end(flag, F.lit(layout))
    eligible = defining & ~G.flagged(flag, G.UNMAPPED | G.SECONDARY | G.SUPPLEMENTARY)
    return alignments.select(
        "sample_id",
        "chrom",
        G.transcript_strand(flag).alias("strand"),
        G.transcript_end(flag, F.col("ref_start"), F.col("ref_end")).alias("pos"),
        defining.alias("defining"),
        eligible.alias("eligible"),
        (eligible & G.flagged(flag, DUPLICATE)).alias("duplicate"),
        (eligible & G.end_clipped(flag, F.col("cigar"), hard=False)).alias("clipped"),
    )


def endpoint_counts(alignments: DataFrame, layout: str = "SE") -> DataFrame:
    """(sample_id, chrom, strand, pos, count) of all eligible reads, duplicates and clipped ones too."""
    return endpoint_reads(alignments, layout).filter("eligible").groupBy("sample_id", *PLACE, "pos").agg(F.count(F.lit(1)).alias("count"))


def endpoint_audit(alignments: DataFrame, layout: str = "SE") -> DataFrame:
    """What became of each sample's records, and the number of places that they end at."""
    per = endpoint_reads(alignments, layout).groupBy("sample_id", *PLACE, "pos").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c)).alias(c) for c in ("defining", "eligible", "duplicate", "clipped")]
    )
    return per.groupBy("sample_id").agg(
        F.sum("n").alias("records"),
        F.sum("eligible").alias("eligible"),
        F.sum("duplicate").alias("duplicates_kept"),
        F.sum("clipped").alias("clipped_kept"),
        F.sum(F.col("n") - F.col("defining")).alias("other_mates"),
        F.count_if(F.col("eligible") > 0).alias("places"),
    )


def priming_masks(places: DataFrame, chunks: DataFrame, width: int) -> DataFrame:
    """(chrom, strand, pos, masked) of the distinct places of ends: whether the sequence about a place is rich
    in the base that primes, see ``genomics.internal_priming``. chunks as of ``readers.read_fasta_chunks``
    with this width, an overlap of ten bases at least. Places beyond the sequence are not masked."""
    at = places.select(*PLACE, "pos").distinct().withColumn("chunk", F.floor(F.col("pos") / width))
    met = at.join(chunks.select("chrom", "chunk", "offset", "sequence"), ["chrom", "chunk"], "left")
    # Nine bases on both sides are all that windows of ten see.
    pos = (F.col("pos") - F.col("offset")).cast("int")
    low = F.greatest(pos - 9, F.lit(0))
    near = met.select(*PLACE, "pos", (pos - low).alias("at"), F.substring("sequence", low + 1, pos - low + 10).alias("near"))
    # Beyond the sequence there is nothing near, or less than the place itself.
    masked = (F.length("near") > F.col("at")) & G.internal_priming(F.col("near"), F.col("at"), F.col("strand"))
    return near.select(*PLACE, "pos", F.coalesce(masked, F.lit(False)).alias("masked"))


def route_masked(ends: DataFrame, masked: Column, rescued: Column) -> DataFrame:
    """Adds ``universe``: C2 for ends that are not masked or are rescued, C2R for the others."""
    return ends.withColumn("universe", F.when(~masked | rescued, "C2").otherwise("C2R"))


def millionths(cpm: Column) -> Column:
    """A value as a whole number of millionths: exact sums as those of decimals with six digits, and cheaper."""
    return F.round(F.round(cpm, 6) * F.lit(1e6)).cast("long")


def sample_totals(ends: DataFrame) -> DataFrame:
    """(sample_id, total): a row a sample."""
    return ends.groupBy("sample_id").agg(F.sum("count").alias("total"))


def scaled_signal(ends: DataFrame, totals: DataFrame) -> DataFrame:
    """(chrom, strand, pos, cpm) of each row of ends in millionths, by (sample_id, total)."""
    value = lambda count: millionths(count * F.lit(1e6) / F.col("total"))
    # A row a sample; samples are tens. Most counts are small: theirs are rounded once a sample, not once a row.
    totals = F.broadcast(totals.filter("total > 0").withColumn("known", F.transform(F.sequence(F.lit(0), F.lit(LOOKED_UP)), value)))
    looked_up = F.when(F.col("count").between(0, LOOKED_UP), F.get("known", F.col("count").cast("int")))
    return ends.join(totals, "sample_id").select(*PLACE, "pos", F.coalesce(looked_up, value(F.col("count"))).alias("cpm"))


def pooled_signal(ends: DataFrame) -> DataFrame:
    """As ``pooled_cpm``, in millionths."""
    return scaled_signal(ends, sample_totals(ends)).groupBy(*PLACE, "pos").agg(F.sum("cpm").alias("cpm"))


def pooled_cpm(ends: DataFrame) -> DataFrame:
    """Condition-blind signal (chrom, strand, pos, cpm): counts per million of each sample, summed.

    Values are decimals, so that sums do not depend on the order of rows."""
    one = F.lit("0.000001").cast("decimal(7,6)")
    return pooled_signal(ends).withColumn("cpm", (F.col("cpm").cast("decimal(20,0)") * one).cast(CPM))


def recenter(components: DataFrame, pooled: DataFrame, sizes: DataFrame, width: int) -> DataFrame:
    """The interval around each component's highest position, the lowest one of ties; signal to six digits."""
    if pooled.schema["cpm"].dataType != LongType():
        pooled = pooled.withColumn("cpm", millionths(F.col("cpm")))
    # Components are few against positions, which need not be sorted to meet them.
    spans = components.select(*PLACE, "start", "end").hint("shuffle_hash")
    held = points_in(pooled.select(*PLACE, "pos", "cpm"), spans, PLACE, "pos", "start", "end", width=FINE)
    # Within a bin height and place are one whole number, so that its best is kept by hash and nothing is sorted.
    one = F.col("cpm") * FINE + (FINE - 1 - F.pmod("pos", F.lit(FINE)))
    best = held.groupBy(*PLACE, "start", "end", F.floor(F.col("pos") / FINE).alias("bin")).agg(F.max(one).alias("one"))
    at = F.col("bin") * FINE + (FINE - 1 - F.pmod("one", F.lit(FINE)))
    summits = best.select(*PLACE, "start", "end", at.alias("pos"), F.floor(F.col("one") / FINE).alias("cpm"))
    summits = summits.groupBy(*PLACE, "start", "end").agg(F.max_by("pos", F.struct("cpm", -F.col("pos"))).alias("summit"))
    return _centered(summits, sizes, width)


def _centered(summits: DataFrame, sizes: DataFrame, width: int) -> DataFrame:
    low, high = G.centered(F.col("summit"), width, F.col("size"))
    return summits.join(F.broadcast(sizes), "chrom").select(*PLACE, "summit", low.alias("start"), high.alias("end"))


def _held(points: DataFrame, spans: DataFrame) -> DataFrame:
    """``points_in`` of narrow spans; a few of them go to where the points lie, and none outside all is looked up."""
    near = nearby(spans)
    low, high = near.agg(F.min("start"), F.max("end")).first()
    return points_in(points.filter(F.col("pos").between(low, high)), near, PLACE, "pos", "start", "end", width=SITE)


def _recentred(spans: DataFrame, signal: DataFrame, sizes: DataFrame, width: int) -> DataFrame:
    """As ``recenter``, of signal with several rows a place; a few spans go to where it lies."""
    held = _held(signal, spans.select(*PLACE, "start", "end"))
    summed = held.groupBy(*PLACE, "start", "end", "pos").agg(F.sum("cpm").alias("cpm"))
    summits = summed.groupBy(*PLACE, "start", "end").agg(F.max_by("pos", F.struct("cpm", -F.col("pos"))).alias("summit"))
    return _centered(summits, sizes, width)


def discover_sites(signal: DataFrame, sizes: DataFrame, threshold: Column, width: int = 30) -> DataFrame:
    """Two rounds of windows, merging and recentring: (chrom, strand, summit, start, end) of signal, pooled or
    with several rows a place that add up. Signal to six digits, or in millionths with such a threshold."""
    if signal.schema["cpm"].dataType != LongType():
        signal, threshold = signal.withColumn("cpm", millionths(F.col("cpm"))), threshold * F.lit(10**6)
    signal = signal.select(*PLACE, "pos", "cpm")
    parts = window_summits(signal.withColumnRenamed("cpm", "value"), PLACE, width, threshold)
    # Written once: a merge reads its rows several times.
    first = written(_centered(parts, sizes, width).filter("end > start").select(*PLACE, "start", "end"))
    return _recentred(merge(first, PLACE, adjacent=True), signal, sizes, width)


def overlapping_sites(sites: DataFrame) -> DataFrame:
    """Sites that the next one on their strand overlaps, with where that starts."""
    order = Window.partitionBy(*PLACE).orderBy("start", "end")
    return sites.withColumn("next_start", F.lead("start").over(order)).filter("next_start < end")


def disjoint(sites: DataFrame) -> DataFrame:
    """The sites; fails while it runs if one overlaps the next. Two rounds of recentring rule that out only
    where signal is sparse, so that runs on real data ask for it and the dense test tables do not."""
    order = Window.partitionBy(*PLACE).orderBy("start", "end")
    next_start = F.lead("start").over(order)
    told = F.concat_ws("/", *PLACE, F.col("start").cast("string"))
    guard = F.when(next_start < F.col("end"), F.raise_error(F.concat(F.lit("sites overlap: "), told)).cast("boolean")).otherwise(F.lit(True))
    return sites.withColumn("apart_", guard).filter("apart_").drop("apart_")


def numbered(sites: DataFrame, prefix: str = "PAS_", digits: int = 8, tile: int = TILE) -> DataFrame:
    """Adds pas_id in the order of the sites, nulls first: numbers inside a tile behind those of the tiles
    before."""
    rows = tiled(sites, ["chrom"], "start", tile)
    per = rows.groupBy("tile_").agg(F.count(F.lit(1)).alias("n_"))
    # A row for each tile of a contig is all that one partition orders.
    ahead = F.sum("n_").over(Window.orderBy("tile_").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.join(per.select("tile_", F.coalesce(ahead, F.lit(0)).alias("ahead_")), "tile_")
    number = F.col("ahead_") + F.row_number().over(Window.partitionBy("tile_").orderBy("start", "strand", "summit"))
    return rows.withColumn("pas_id", F.concat(F.lit(prefix), F.lpad(number.cast("string"), digits, "0"))).select(*sites.columns, "pas_id")


def supported(counts: DataFrame, total: int = 5, samples: int = 2) -> DataFrame:
    """(pas_id, total, supporting_samples) of sites with so many ends in so many samples."""
    per = counts.groupBy("pas_id").agg(F.sum("count").alias("total"), F.count_if(F.col("count") > 0).alias("supporting_samples"))
    return per.filter((F.col("total") >= total) & (F.col("supporting_samples") >= samples))


def site_totals(ends: DataFrame, counts: DataFrame, catalog: DataFrame, premature: DataFrame) -> DataFrame:
    """(sample_id, c2, c3, c3_pct) with the catalog's sites, ambiguous and premature ones; fails while it
    runs if a sample has more ends in sites than it has ends."""
    c2 = ends.groupBy("sample_id").agg(F.sum("count").cast("long").alias("c2"))
    c3 = counts.groupBy("sample_id").agg(F.sum("count").cast("long").alias("c3"))
    sites = catalog.agg(F.count(F.lit(1)).alias("active_sites"), F.count_if(F.col("assignment_status") == "ambiguous").alias("ambiguous_sites"))
    early = premature.select("pas_id").distinct().agg(F.count(F.lit(1)).alias("premature_sites"))
    both = c2.join(c3, "sample_id", "left").withColumn("c3", F.coalesce("c3", F.lit(0).cast("long")))
    more = F.raise_error(F.concat(F.lit("more ends in sites than ends: "), F.col("sample_id"))).cast("boolean")
    kept = both.filter(F.when(F.col("c3") > F.col("c2"), more).otherwise(F.lit(True)))
    one = sites.join(F.broadcast(early))  # a row each
    return kept.join(F.broadcast(one)).withColumn("c3_pct", F.round(100.0 * F.col("c3") / F.col("c2"), 2))


def count_sites(sites: DataFrame, ends: DataFrame, samples: DataFrame) -> DataFrame:
    """(pas_id, sample_id, count) with zeros for samples without an end in a site."""
    held = _held(ends.select("sample_id", *PLACE, "pos", "count"), sites.select(*PLACE, "pas_id", "start", "end"))
    sums = held.groupBy("pas_id", "sample_id").agg(F.sum("count").alias("count"))
    # A row for each site and sample is what the matrix is; samples are tens.
    grid = sites.select("pas_id").join(samples.select("sample_id").distinct().hint("broadcast"))
    return grid.join(sums, ["pas_id", "sample_id"], "left").select("pas_id", "sample_id", F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def gene_counts(catalog: DataFrame, counts: DataFrame) -> DataFrame:
    """Counts of genes over their unambiguous sites."""
    unique = catalog.filter("assignment_status = 'unique' and gene_id <> ''").select("pas_id", "gene_id")
    return counts.join(unique, "pas_id").groupBy("gene_id", "sample_id").agg(F.sum("count").cast("long").alias("count"))
