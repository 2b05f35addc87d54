"""Compression of vectors to short codes by Lloyd rounds on heaps.

A vector's components become integers and the vector is cut into equal parts; each part is coded by
its nearest entry of the codebook of its position. Rounds follow Lloyd, but only rescan what can have
moved: when a part is scanned, the distance to its second nearest entry less that to the nearest is its
slack. An entry keeps its parts in a heap, local to a block of rows, keyed by slack; while codebooks
move, slack shrinks by at most the entry's own drift and the largest drift of any other. What an entry's
cumulative drift has passed is popped and rescanned exactly, everything else stays as it is.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from endweave.llm.common import bucketed, columns_of, cut, nearby

#: Parts of a vector, entries of a codebook, Lloyd rounds, and the steps of a component to one.
PARTS, ENTRIES, ROUNDS, STEPS = 4, 256, 4, 1024
#: Rows of a block, which has heaps of its own, and rows whose distances are held at a time.
BLOCK, AT_ONCE = 4096, 1024
#: Share of distances by which bounds are drawn in, far above what rounding can add up to.
MARGIN = 1e-11


def largest(length: int) -> int:
    """The largest magnitude of a component: what keeps errors of whole vectors in 62 bits."""
    return math.isqrt((1 << 60) // max(length, 1))


def quantised(values: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(values.astype(np.float64) * STEPS, -(2.0**40), 2.0**40)).astype(np.int64)


def _stored(rows: np.ndarray) -> tuple[int, bytes]:
    """(bytes of a component, components): as few bytes as hold them all."""
    most = np.abs(rows).max() if rows.size else 0
    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64
    return np.dtype(kind).itemsize, rows.astype(kind).tobytes()


def _parts(data: bytes, width: int, n: int, length: int) -> np.ndarray:
    """(part, row, component) of a block, padded with zeros to ``length`` components."""
    rows = np.frombuffer(data, dtype=f"<i{width}").reshape(n, -1).astype(np.int64)
    rows = np.pad(rows, ((0, 0), (0, length - rows.shape[1])))
    most = largest(length)
    return np.clip(rows, -most, most).reshape(n, PARTS, length // PARTS).transpose(1, 0, 2)


def squared(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances (row, entry): products of doubles where 53 bits hold them, else integers."""
    most = max(np.abs(rows).max(initial=0), np.abs(book).max(initial=0))
    if 4 * int(most) ** 2 * max(rows.shape[1], 1) < 1 << 53:
        x, c = rows.astype(np.float64), book.astype(np.float64)
        return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]
    return np.stack([((rows - entry) ** 2).sum(axis=1) for entry in book], axis=1)


def nearest(rows: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, the lower of equals; slack: how much farther the second is, at least)."""
    entry, slack = np.zeros(len(rows), dtype=np.int64), np.full(len(rows), np.inf)
    for at in range(0, len(rows), AT_ONCE):
        far = squared(rows[at : at + AT_ONCE], book)
        best, i = far.argmin(axis=1), np.arange(len(far))
        upper = np.sqrt(far[i, best].astype(np.float64))
        entry[at : at + AT_ONCE] = best
        if far.shape[1] > 1:
            lower = np.sqrt(np.partition(far, 1, axis=1)[:, 1].astype(np.float64))
            slack[at : at + AT_ONCE] = lower * (1 - MARGIN) - upper * (1 + MARGIN)
    return entry, slack


class Heaps:
    """The heaps of one part position of a block: rows in the order of (entry, key), so that each entry
    has a run with its smallest key at the head. Pops take the front of a run, pushes are merged in."""

    def __init__(self, rows: np.ndarray, keys: np.ndarray, starts: np.ndarray):
        self.rows, self.keys, self.starts = rows, keys, starts

    @classmethod
    def empty(cls) -> Heaps:
        return cls(np.zeros(0, np.int32), np.zeros(0), np.zeros(ENTRIES + 1, np.int32))

    def entries(self) -> np.ndarray:
        return np.repeat(np.arange(ENTRIES), np.diff(self.starts))

    def pop(self, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Takes out and returns (rows, their entries) with keys that their entry's drift has reached."""
        some = np.flatnonzero(np.diff(self.starts))
        gone = np.zeros(len(self.rows), dtype=bool)
        for e in some[self.keys[self.starts[some]] <= drift[some]]:
            low, high = self.starts[e], self.starts[e + 1]
            gone[low : low + np.searchsorted(self.keys[low:high], drift[e], side="right")] = True
        entries = self.entries()
        out = self.rows[gone], entries[gone]
        self.rows, self.keys = self.rows[~gone], self.keys[~gone]
        self.starts = np.searchsorted(entries[~gone], np.arange(ENTRIES + 1)).astype(np.int32)
        return out

    def push(self, rows: np.ndarray, entries: np.ndarray, keys: np.ndarray) -> None:
        entry, key = np.concatenate([self.entries(), entries]), np.concatenate([self.keys, keys])
        order = np.lexsort((key, entry))
        self.rows, self.keys = np.concatenate([self.rows, rows.astype(np.int32)])[order], key[order]
        self.starts = np.searchsorted(entry[order], np.arange(ENTRIES + 1)).astype(np.int32)

    def pack(self) -> bytes:
        return self.starts.tobytes() + self.rows.tobytes() + self.keys.tobytes()

    @classmethod
    def unpack(cls, data: memoryview, n: int) -> tuple[Heaps, memoryview]:
        a, b, c = 4 * (ENTRIES + 1), 4 * (ENTRIES + 1) + 4 * n, 4 * (ENTRIES + 1) + 12 * n
        read = cls(np.frombuffer(data[a:b], np.int32), np.frombuffer(data[b:c], np.float64), np.frombuffer(data[:a], np.int32))
        return read, data[c:]


def _advanced(x: np.ndarray, heaps: bytes | None, books: np.ndarray, drift: np.ndarray, moved=None) -> list[Heaps]:
    """The heaps of a block after the codebooks have moved; ``moved(part, rows, from, to)`` is told what
    changed its entry, with -1 for what had none."""
    out, left = [], memoryview(heaps) if heaps is not None else None
    for p in range(PARTS):
        if left is None:
            heap = Heaps.empty()
            rows, before = np.arange(x.shape[1], dtype=np.int32), np.full(x.shape[1], -1)
        else:
            heap, left = Heaps.unpack(left, x.shape[1])
            rows, before = heap.pop(drift[p])
        entry, slack = nearest(x[p, rows], books[p])
        heap.push(rows, entry, slack + drift[p, entry])
        if moved is not None:
            other = before != entry
            moved(p, x[p, rows[other]], before[other], entry[other])
        out.append(heap)
    return out


def _blocks():
    """Rows of ``id_``, ``label_`` and ``vector_`` as blocks, numbered by their task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                vectors = part.column("vector_")
                lengths = np.asarray(vectors.value_lengths(), dtype=np.int64)
                values = quantised(np.asarray(vectors.flatten()))
                rows = np.zeros((len(lengths), lengths.max(initial=0)), dtype=np.int64)
                rows[np.arange(rows.shape[1])[None, :] < lengths[:, None]] = values
                width, data = _stored(rows)
                one = pa.array([0, part.num_rows], pa.int32())
                lists = [pa.ListArray.from_arrays(one, pa.concat_arrays([part.column(c)])) for c in ("id_", "label_")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), *lists, pa.array([rows.shape[1]], pa.int32()), pa.array([width], pa.int32()), pa.array([data], pa.binary())],
                    names=["block", "ids", "labels", "length", "width", "data"],
                )
                number += 1

    return run


def _round(books: np.ndarray, drift: np.ndarray, length: int):
    """Rows (block, heaps) of every block, and one of (part, entry, count, sums) of what a task's parts
    have brought to an entry or taken from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((PARTS, ENTRIES), dtype=np.int64)
        sums = np.zeros((PARTS, ENTRIES, length // PARTS), dtype=np.int64)
        touched = np.zeros((PARTS, ENTRIES), dtype=bool)

        def moved(p: int, rows: np.ndarray, before: np.ndarray, after: np.ndarray) -> None:
            for entries, sign in ((after, 1), (before, -1)):
                held = entries >= 0
                np.add.at(counts[p], entries[held], sign)
                np.add.at(sums[p], entries[held], sign * rows[held])
                touched[p, entries[held]] = True

        kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        names = ["block", "heaps", "part", "entry", "count", "sums"]
        for batch in batches:
            for r in batch.to_pylist():
                x = _parts(r["data"], r["width"], r["n"], length)
                heaps = b"".join(h.pack() for h in _advanced(x, r["heaps"], books, drift, moved))
                values = [[r["block"]], [heaps], [None], [None], [None], [None]]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=names)
        part, entry = np.nonzero(touched)
        none = [None] * len(part)
        values = [none, none, part, entry, counts[part, entry], list(sums[part, entry])]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names=names)

    return run


def _coded(books: np.ndarray, drift: np.ndarray, length: int):
    """(id, label, code, error) of every row after the last assignment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = batch.column("ids"), batch.column("labels")
            for i, r in enumerate(batch.select(["width", "data", "heaps", "n"]).to_pylist()):
                x = _parts(r["data"], r["width"], r["n"], length)
                code, error = np.zeros((r["n"], PARTS), dtype=np.uint8), np.zeros(r["n"], dtype=np.int64)
                for p, heap in enumerate(_advanced(x, r["heaps"], books, drift)):
                    code[heap.rows, p] = heap.entries()
                    error += ((x[p] - books[p][code[:, p]]) ** 2).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [ids[i].values, labels[i].values, pa.array([c.tobytes().hex() for c in code], pa.string()), pa.array(error)],
                    names=["id_", "label_", "code", "error"],
                )

    return run


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """One row per kept vector: id, code (two hex digits for each of the 4 parts), error (squared, over
    all parts), label_error (of all rows with the label), codebooks_sha256 (of the final entries).

    Dropped are rows whose vector is null or holds a null or a component that is not finite. Codebooks
    begin with the parts of the 256 smallest ids (null last, equal ids by vector and label), or of as many
    as there are. A vector that is shorter than the longest one, or whose length is no multiple of 4, is
    padded with zeros; an empty vector counts as zeros. Integer components beyond ``largest`` (2^27 of
    vectors of 64) count as that, so that errors fit; label_error is null if it does not fit in a long. A
    null label is a label. Repeated rows are rows of their own; an empty table gives an empty result.
    Other columns are not read.

    The codebooks and what moved between their entries, sums of one row an entry and task, are all that
    meets on the driver. Blocks of rows are written once, in buckets; a round reads them where they lie
    and writes heaps alone, a fifth of their bytes.
    """
    spark = vectors.sparkSession
    given = columns_of(vectors, id_col, vector_col, label_col)
    rows = given.select(F.col(id_col).alias("id_"), F.col(label_col).alias("label_"), F.col(vector_col).cast("array<double>").alias("vector_"))
    fine = F.forall("vector_", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.filter(F.col("vector_").isNotNull() & fine)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    out = T.StructType([T.StructField("id_", kinds["id_"]), T.StructField("label_", kinds["label_"]), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def named(df: DataFrame) -> DataFrame:
        return df.select(F.col("id_").alias(id_col), "code", "error", "label_error", "codebooks_sha256")

    # A block's rows stay together from here on: written by blocks, joined to their heaps where they lie.
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("ids", T.ArrayType(kinds["id_"])),
            T.StructField("labels", T.ArrayType(kinds["label_"])),
            T.StructField("length", T.IntegerType()),
            T.StructField("width", T.IntegerType()),
            T.StructField("data", T.BinaryType()),
        ]
    )
    blocks = rows.mapInArrow(_blocks(), schema).withColumn("n", F.size("ids"))
    with bucketed(blocks, "block") as dealt:
        coded, digest = _lloyd(rows, dealt, out, rounds)
    if coded is None:
        empty = spark.createDataFrame([], out)
        return named(empty.withColumns({"label_error": F.lit(0).cast("long"), "codebooks_sha256": F.lit("")}))
    by_label = cut(coded.groupBy(F.col("label_").alias("of_")).agg(F.try_sum("error").alias("label_error")))
    done = coded.join(nearby(by_label), coded.label_.eqNullSafe(by_label.of_)).withColumn("codebooks_sha256", F.lit(digest))
    return named(done)


def _lloyd(rows: DataFrame, blocks: DataFrame, out: T.StructType, rounds: int) -> tuple[DataFrame | None, str]:
    """(coded rows as a written table, None without a row; digest of the codebooks)."""
    longest = blocks.agg(F.max("length")).first()[0]
    if longest is None:
        return None, ""
    length = PARTS * -(-longest // PARTS)
    first = rows.orderBy(F.col("id_").asc_nulls_last(), "vector_", "label_").limit(ENTRIES).select("vector_").collect()
    seeds = np.zeros((len(first), length), dtype=np.int64)
    for i, r in enumerate(first):
        seeds[i, : len(r[0])] = quantised(np.array(r[0], dtype=np.float64))
    seeds = np.clip(seeds, -largest(length), largest(length))
    books = seeds.reshape(len(first), PARTS, length // PARTS).transpose(1, 0, 2).copy()

    drift = np.zeros((PARTS, ENTRIES))
    counts, sums = np.zeros((PARTS, ENTRIES), dtype=np.int64), np.zeros((PARTS, ENTRIES, length // PARTS), dtype=np.int64)
    changes = "block long, heaps binary, part int, entry int, count long, sums array<long>"
    held = blocks.withColumn("heaps", F.lit(None).cast("binary"))
    for _ in range(rounds):
        state = cut(held.select("block", "width", "data", "heaps", "n").mapInArrow(_round(books, drift, length), changes))
        told = state.filter("part is not null").groupBy("part", "entry").agg(
            F.sum("count").alias("count"), F.array(*[F.sum(F.col("sums")[i]) for i in range(length // PARTS)]).cast("array<long>").alias("sums")
        )
        for r in told.collect():  # a row for each entry, at most
            counts[r.part, r.entry] += r["count"]
            sums[r.part, r.entry] += np.array(r["sums"], dtype=np.int64)
        used = counts[:, : books.shape[1]]
        means = np.where(used[..., None] > 0, sums[:, : books.shape[1]] // np.maximum(used, 1)[..., None], books)
        steps = np.zeros((PARTS, ENTRIES))
        steps[:, : books.shape[1]] = np.sqrt(((means - books).astype(np.float64) ** 2).sum(axis=2)) * (1 + MARGIN)
        # The largest step of any other entry: that of the one that moved most, and for it the second.
        ranked = np.sort(steps, axis=1)
        others = np.repeat(ranked[:, -1:], ENTRIES, axis=1)
        others[np.arange(PARTS), steps.argmax(axis=1)] = ranked[:, -2]
        drift, books = drift + steps + others, means
        held = blocks.join(state.filter("block is not null").select("block", "heaps").hint("merge"), "block")
    coded = cut(held.select("ids", "labels", "width", "data", "heaps", "n").mapInArrow(_coded(books, drift, length), out))
    return coded, hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
