"""Lift-over of positions by chains of aligned blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from endweave.operators.intervals import points_in

#: Width of the bins in which blocks and positions meet.
WIDTH = 1 << 14


def blocks(chains: DataFrame) -> DataFrame:
    """Aligned blocks (chain_id, chrom, start, end, to_chrom, to_start, to_strand, to_size) of chains, rows of
    (chain_no, chain_id, chrom, at, to_chrom, to_at, to_strand, to_size, line_no, size, gap, to_gap): a block
    begins behind the blocks and gaps before it, ``at`` and ``to_at`` are where the chain does.

    to_start counts on the strand that the chain goes to, from its own beginning."""
    order = Window.partitionBy("chain_no").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda gap: F.coalesce(F.sum(F.col("size") + F.coalesce(F.col(gap), F.lit(0))).over(order), F.lit(0))
    start, to_start = F.col("at") + before("gap"), F.col("to_at") + before("to_gap")
    return chains.select("chain_id", "chrom", start.alias("start"), (start + F.col("size")).alias("end"), "to_chrom", to_start.alias("to_start"), "to_strand", "to_size")


def hits(records: DataFrame, blocks: DataFrame, key: str = "source_id", pos: str = "pos") -> DataFrame:
    """(key, to_chrom, to_pos, to_strand, chain_id) for each block that holds a record (key, chrom, strand, pos):
    none in a gap, several where chains overlap. On a chain to the other strand positions count from the
    end, and the record's strand turns; a record without a strand stays without."""
    at = records.select(F.col(key), "chrom", F.col("strand").alias("from_strand"), F.col(pos).alias("from_pos"))
    met = points_in(at, blocks, ["chrom"], "from_pos", "start", "end", width=WIDTH)
    there = F.col("to_start") + F.col("from_pos") - F.col("start")
    back = F.col("to_strand") == "-"
    turned = F.when(~back, F.col("from_strand")).when(F.col("from_strand") == "+", "-").when(F.col("from_strand") == "-", "+").otherwise(F.col("from_strand"))
    return met.select(key, "to_chrom", F.when(back, F.col("to_size") - 1 - there).otherwise(there).alias("to_pos"), turned.alias("to_strand"), "chain_id")

