"""Best-fit packing of documents into sequences of a fixed number of words, under conflicts.

Documents are dealt to blocks by a hash and packed there, largest first. Bins lie in the order of
their residual room and carry bitmaps: of the duplicate clusters in them, and of the sources, one
plane for each time a source may occur. A document goes to the tightest bin with room for it that
neither bitmap forbids; the search goes on from successor to successor until one is found.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from endweave.llm.common import SPACE, WORD, columns_of, cut, partitions, text_or_empty

#: Rows of a block, on average and at most twice.
BLOCK = 8192


class Bins:
    """Open bins of one block. ``first`` is the number of its first bin."""

    def __init__(self, capacity: int, per_source: int, first: int = 0):
        self.capacity, self.per_source, self.first = capacity, per_source, first
        self.order: list[tuple[int, int]] = []  # (residual, bin)
        self.clusters: list[int] = []
        self.planes: list[list[int]] = []
        self.last: tuple | None = None
        self.next_at = 0

    def place(self, size: int, cluster: int, source: int) -> tuple[int, int]:
        """(bin, offset in it). cluster: -1 if nothing else in the block is of its cluster."""
        at = bisect_left(self.order, (size, -1))
        if cluster >= 0 and self.last == (size, cluster, source):
            at = max(at, self.next_at)  # what the row before found forbidden is so for this one
        c, s = 1 << max(cluster, 0), 1 << source
        while at < len(self.order):
            residual, b = self.order[at]
            if not (cluster >= 0 and self.clusters[b] & c) and not self.planes[b][-1] & s:
                break
            at += 1
        if at < len(self.order):
            self.order.pop(at)
            self.next_at = at + 1
        else:
            b, residual = len(self.clusters), self.capacity
            self.clusters.append(0)
            self.planes.append([0] * self.per_source)
            self.next_at = len(self.order) + 1
        if cluster >= 0:
            self.clusters[b] |= c
        for i, plane in enumerate(self.planes[b]):
            if not plane & s:
                self.planes[b][i] |= s
                break
        insort(self.order, (residual - size, b))
        self.last = (size, cluster, source)
        return self.first + b, self.capacity - residual

    def whole(self) -> int:
        """A bin that a full piece takes alone; it is never open."""
        self.clusters.append(0)
        self.planes.append([0] * self.per_source)
        return self.first + len(self.clusters) - 1


def pack_block(rows: list[tuple], capacity: int, per_source: int, first: int = 0) -> tuple[list[tuple], int]:
    """Pieces (id, piece, start, n, bin, offset) of rows (id, size, cluster, source), and the bins used.

    Rows come largest first. What is longer than a bin is cut into full bins and a rest.
    """
    bins = Bins(capacity, per_source, first)
    many = Counter(r[2] for r in rows)
    cluster_of = {c: i for i, c in enumerate(c for c, n in many.items() if n > 1)}
    source_of: dict = {}
    pieces, rests = [], []
    for id_, size, cluster, source in rows:
        full, rest = divmod(size, capacity)
        for i in range(full):
            pieces.append((id_, i, i * capacity, capacity, bins.whole(), 0))
        if rest:
            rests.append((rest, cluster_of.get(cluster, -1), source_of.setdefault(source, len(source_of)), id_, full))
    rests.sort(key=lambda r: (-r[0], r[1], r[2]))
    for rest, cluster, source, id_, full in rests:
        b, offset = bins.place(rest, cluster, source)
        pieces.append((id_, full, full * capacity, rest, b, offset))
    return pieces, len(bins.clusters)


def _pack(capacity: int, per_source: int, id_name: str):
    names = [id_name, "piece", "start_word", "n_words", "bin_id", "bin_offset"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, used, rows = None, 0, []

        def out() -> pa.RecordBatch:
            nonlocal used
            pieces, n = pack_block(rows, capacity, per_source, (block << 32) + used)
            used += n
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*pieces, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for b, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (b != block or len(rows) == 2 * BLOCK):
                    yield out()
                    rows = []
                if b != block:
                    block, used = b, 0
                rows.append(row)
        if rows:
            yield out()

    return run


def pack(
    docs: DataFrame,
    capacity: int = 4096,
    per_source: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Pieces of documents in bins: id, piece, start_word, n_words, bin_id, bin_offset.

    A bin holds at most ``capacity`` words, never two documents of one duplicate cluster (texts
    equal but for white space), and at most ``per_source`` of one source; a null source is a source
    of its own. A document longer than a bin is cut: full pieces fill bins alone, the rest is packed
    like any other document, so that every word is in exactly one piece. A null text, and one
    without words, is one piece of 0 words without a bin (bin_id null). A null id is kept; repeated
    rows are packed each. Bins are those of a block of about 8192 rows; more than twice as many rows
    that are alike in all a block goes by are packed in turns. An empty table gives an empty result;
    columns other than the three named are not read.
    """
    spark = docs.sparkSession
    rows = columns_of(docs, id_col, text_col, source_col).select(
        F.col(id_col).cast("long").alias("id"),
        F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.regexp_replace(text_or_empty(text_col), SPACE, " ")).alias("cluster"),
        F.col(source_col).cast("string").alias("source"),
    )
    rows = cut(rows)
    blocks = max(1, -(-rows.count() // BLOCK))
    block = F.pmod(F.xxhash64("id", "cluster", "size"), F.lit(blocks)).cast("long")
    dealt = (
        rows.filter("size > 0")
        .select(block.alias("block"), "id", "size", "cluster", "source")
        .repartition(partitions(spark), "block")
        .sortWithinPartitions("block", F.col("size").desc(), "cluster", "source", "id")
    )
    schema = f"{id_col} long, piece int, start_word long, n_words long, bin_id long, bin_offset long"
    packed = dealt.mapInArrow(_pack(capacity, per_source, id_col), schema)
    none = F.lit(None).cast("long")
    wordless = rows.filter("size = 0").select(
        F.col("id").alias(id_col), F.lit(0).cast("int").alias("piece"), F.lit(0).cast("long").alias("start_word"), F.lit(0).cast("long").alias("n_words"), none.alias("bin_id"), none.alias("bin_offset")
    )
    return packed.union(wordless)
