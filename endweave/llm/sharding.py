"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Keys are points on a ring of arcs, each arc ending at a virtual node of a shard. A key belongs to
the shard of its arc; what a full shard cannot take continues clockwise to the next shards. The
loads are bounded by the exact mean, so that shards differ by one row at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from endweave.llm.common import columns_of, cut

#: Virtual nodes of each shard.
VIRTUAL = 128


def ring(shards: int, virtual: int = VIRTUAL) -> tuple[np.ndarray, np.ndarray]:
    """(positions ascending, shard of each): a virtual node's position depends on its shard alone."""
    nodes = [
        (int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "little", signed=True), s)
        for s in range(shards)
        for v in range(virtual)
    ]
    nodes.sort()
    return np.array([x for x, _ in nodes], dtype=np.int64), np.array([s for _, s in nodes], dtype=np.int64)


def quotas(counts: np.ndarray, owner: np.ndarray, shards: int) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, rank after the last, shard, first slot): who takes which keys of an arc.

    In the r-th round the keys still without a place go to the r-th different shard clockwise from
    their arc, arcs in ring order, until the shard holds its share. Shares are the mean, rounded
    up for the first shards and down for the others, and add up to all keys. The work is on arcs
    and shards alone, whatever the number of keys.
    """
    arcs, total = len(owner), int(counts.sum())
    room = np.array([total // shards + (s < total % shards) for s in range(shards)], dtype=np.int64)
    filled = np.zeros(shards, dtype=np.int64)
    clockwise = []
    for a in range(arcs):
        seen: list[int] = []
        for i in range(arcs):
            s = int(owner[(a + i) % arcs])
            if s not in seen:
                seen.append(s)
                if len(seen) == shards:
                    break
        clockwise.append(seen)
    left, done, out = counts.astype(np.int64).copy(), np.zeros(arcs, dtype=np.int64), []
    for r in range(shards):
        for a in np.flatnonzero(left):
            if r >= len(clockwise[a]):
                continue
            s = clockwise[a][r]
            n = int(min(left[a], room[s] - filled[s]))
            if n > 0:
                out.append((int(a), int(done[a]), int(done[a]) + n, s, int(filled[s])))
                filled[s] += n
                done[a] += n
                left[a] -= n
    return out


def shard(
    docs: DataFrame, shards: int = 16, virtual: int = VIRTUAL, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard, home_shard.

    A row's key is its id together with its text's checksum and length; a null id or text is a key
    like any other, a null text has the size 1 and the checksum of the empty text. Shards hold the
    same number of rows, at most one apart (law ``rows``), and slots count from 0 in each. Equal texts
    are keys of their own and not kept together: a group of copies may be larger than a shard. Rows
    that are equal in id and text are alike: which of them has which slot is open, and all else is
    the same for every run. ``home_shard`` is where the ring puts a key as long as there is room;
    adding a shard moves keys into it and those that bounded loads pass on. An empty table gives an
    empty result; columns other than the two named are not read.
    """
    spark = docs.sparkSession
    positions, owner = ring(shards, virtual)
    arcs = len(owner)

    @F.pandas_udf("int")
    def arc_of(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for keys in series:
            yield pd.Series((np.searchsorted(positions, keys.to_numpy(dtype=np.int64)) % arcs).astype(np.int32))

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = columns_of(docs, id_col, text_col).select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("crc"),
    )
    rows = cut(rows.withColumn("key", F.xxhash64("id", "crc", "size")).withColumn("arc", arc_of("key")))
    counts = np.zeros(arcs, dtype=np.int64)
    for row in rows.groupBy("arc").count().collect():  # a row for each arc
        counts[row["arc"]] = row["count"]
    table = spark.createDataFrame(
        quotas(counts, owner, shards), "arc int, first long, last long, shard int, slot0 long"
    )
    home = spark.createDataFrame(list(enumerate(owner.tolist())), "arc int, home_shard int")
    # Arcs and rounds bound both tables, whatever the rows.
    order = Window.partitionBy("arc").orderBy("key", F.col("id"), "crc", "size")
    ranked = rows.withColumn("rank", (F.row_number().over(order) - 1).cast("long"))
    placed = ranked.join(F.broadcast(table), "arc").filter("rank >= first and rank < last").join(F.broadcast(home), "arc")
    return placed.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("slot0") + F.col("rank") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("home_shard").cast("int").alias("home_shard"),
    )
