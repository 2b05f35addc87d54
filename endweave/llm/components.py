"""Connected components of an edge table.

Every partition first replaces its edges by a spanning forest. What is left then goes to one task,
if it is at most FEW edges, or through alternating large and small stars until nothing changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from endweave.llm.common import cut, dealt_anew

#: Edges that one task may finish (16 bytes each, some 60 MB with what it makes of them), and edges
#: that a task holds at a time while it contracts.
FEW, HELD = 1 << 19, 1 << 17


def roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nodes ascending, the smallest node that each reaches) of the edges (u, v)."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return nodes, nodes[label]
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def _forest(whole: bool):
    """Edges (u, v) of a star for each component of a task's edges; ``whole``: of all of them at
    once, with a row for the centre."""

    names = ["node", "label"] if whole else ["u", "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            nodes, least = roots(np.concatenate([u for u, _ in held]), np.concatenate([v for _, v in held]))
            kept = slice(None) if whole else nodes != least
            return pa.RecordBatch.from_arrays([pa.array(nodes[kept], pa.int64()), pa.array(least[kept], pa.int64())], names=names)

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            if not whole and sum(len(u) for u, _ in held) > HELD:
                yield out()
                held = []
        if held:
            yield out()

    return run


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _both(edges)
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(dealt_anew(least, "u"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(dealt_anew(least, "u"), "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """(node, label): the smallest node reachable from each node of the edges (u, v).

    Nodes of no edge are not in the result; no edges give an empty result. Edges stay in Spark,
    and every round is written to the checkpoint folder. Both ways give the same labels: ``few``
    decides only when one task is cheaper than further rounds.
    """
    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = cut(edges.mapInArrow(_forest(False), "u long, v long"))
    seen = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now[0] <= few:
            return cut(edges.coalesce(1).mapInArrow(_forest(True), "node long, label long"))
        if now == seen:
            break
        seen = now
        edges = cut(_small_star(_large_star(edges)))
    roots_ = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots_.select("node", F.col("node").alias("label")))
