"""Document fingerprints by one-permutation MinHash.

One hash of every shingle gives both its bin and its value; a bin keeps its least value. Empty
bins borrow the value of a bin that a 2-universal sequence of their own finds first (optimal
densification). Of every value only the lowest bits are kept, packed; likeness is the share of
equal bins, corrected for values whose low bits agree by chance.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from endweave.llm.common import columns_of, partitions
from endweave.llm.wordhash import chunks, mix64, shingle_hashes, word_hashes

BINS_LOG, BITS = 9, 4
BINS = 1 << BINS_LOG
_EMPTY = np.uint64((1 << 64) - 1)
#: Ranges of keys for each shuffle partition, and keys drawn for each range to find them.
RANGES, DRAWN = 4, 64


def densified(bins: np.ndarray) -> np.ndarray:
    """Fills empty bins of each row from full ones; rows without a full bin stay empty."""
    out = bins.copy()
    full = bins != _EMPTY
    row, at = np.nonzero(~full & full.any(axis=1)[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        probe = mix64(at.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt)) >> np.uint64(64 - BINS_LOG)
        probe = probe.astype(np.int64)
        hit = full[row, probe]
        out[row[hit], at[hit]] = bins[row[hit], probe[hit]]
        row, at = row[~hit], at[~hit]
    return out


def low_bits(column: pa.Array, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(low bits of every bin, whether the row has a shingle) for a string column."""
    bits, some = [], []
    for _, _, data, offsets in chunks(column):
        words, counts = word_hashes(data, offsets)
        values, per = shingle_hashes(words, counts, k)
        rows = np.repeat(np.arange(len(per)), per)
        bins = np.full(len(per) * BINS, _EMPTY, dtype=np.uint64)
        place = (values >> np.uint64(64 - BINS_LOG)).astype(np.int64)
        np.minimum.at(bins, rows * BINS + place, values & np.uint64((1 << (64 - BINS_LOG)) - 1))
        bins = densified(bins.reshape(len(per), BINS))
        bits.append((bins & np.uint64((1 << BITS) - 1)).astype(np.uint8))
        some.append(per > 0)
    if not bits:
        return np.zeros((0, BINS), dtype=np.uint8), np.zeros(0, dtype=bool)
    return np.concatenate(bits), np.concatenate(some)


def packed(bits: np.ndarray, some: bool) -> str:
    """The printable fingerprint; that of a text without words is the empty string."""
    return base64.b64encode((bits[0::2] << 4 | bits[1::2]).tobytes()).decode() if some else ""


def unpacked(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), dtype=np.uint8)
    return np.stack([raw >> 4, raw & 15], axis=1).reshape(-1)


def likeness(a: np.ndarray, a_some: np.ndarray, b: np.ndarray, b_some: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity, 0 to 1; two texts without words are alike, one is unlike any other."""
    chance = 1.0 / (1 << BITS)
    share = ((a == b).mean(axis=1) - chance) / (1 - chance)
    return np.where(a_some & b_some, np.clip(share, 0.0, 1.0), (a_some == b_some).astype(float))


def fingerprint_similarity(a: str, b: str) -> float:
    if not a or not b:
        return float(a == b)
    one = np.ones(1, dtype=bool)
    return float(likeness(unpacked(a)[None], one, unpacked(b)[None], one)[0])


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(k: int, names: list[str]):
    """Rows (bucket, ahead, id, text) in order; ahead marks the row that follows a bucket's last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out(rows: list[tuple]) -> pa.RecordBatch | None:
            """For all rows but the last, which is held back until the next rows come."""
            if len(rows) < 2:
                return None
            own, own_some = low_bits(pa.array([r[3] for r in rows], pa.large_string()), k)
            keep = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i + 1][0] == rows[i][0]]
            if not keep:
                return None
            changed = [edited(rows[i][3], rows[i + 1][3]) for i in keep]
            new, new_some = low_bits(pa.array(changed, pa.large_string()), k)
            at = np.array(keep)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[i][2] for i in keep], pa.int64()),
                    pa.array([len(rows[i][3]) for i in keep], pa.int64()),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in changed], pa.string()),
                    pa.array([packed(own[i], own_some[i]) for i in keep], pa.string()),
                    pa.array([packed(new[i], new_some[i]) for i in range(len(keep))], pa.string()),
                    pa.array(likeness(own[at], own_some[at], new, new_some), pa.float64()),
                    pa.array(likeness(own[at], own_some[at], own[at + 1], own_some[at + 1]), pa.float64()),
                ],
                names=names,
            )

        for batch in batches:
            bucket, ahead, ids = (batch.column(i).to_pylist() for i in range(3))
            texts = batch.column(3)
            size = 0
            for i in range(len(ids)):
                held.append((bucket[i], ahead[i], ids[i], texts[i].as_py()))
                size += len(held[-1][3])
                if size > 1 << 18 or len(held) > 500:
                    if (made := out(held)) is not None:
                        yield made
                    held, size = held[-1:], 0
        if (made := out(held)) is not None:
            yield made

    return run


def _borders(keys: DataFrame, total: int, ranges: int) -> list[tuple[int, int, int]]:
    """At most ``ranges`` keys (0 for a null id, id, checksum of the text) that cut the rows into
    ranges of about equal numbers, from about DRAWN keys for each range. Which keys are drawn has
    a bearing on where rows are worked on, not on results."""
    drawn = keys.filter(F.rand(6) < min(1.0, ranges * DRAWN / max(total, 1))).toArrow()
    some, ids, h = (drawn.column(c).combine_chunks().fill_null(0).to_numpy(zero_copy_only=False) for c in ("some", "id", "h"))
    order = np.lexsort((h, ids, some))
    at = order[np.arange(1, ranges) * len(order) // ranges] if len(order) else order
    return sorted({(int(some[i]), int(ids[i]), int(h[i])) for i in at})


def _bucket_of(borders: list[tuple[int, int, int]]):
    """Number of borders up to each key (some, id, h)."""

    @F.pandas_udf("int")
    def bucket(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for some, ids, h in batches:
            keys = zip(some.tolist(), ids.tolist(), h.tolist(), strict=True)
            yield pd.Series([bisect_right(borders, key) for key in keys], dtype="int32")

    return bucket


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(bucket, ahead, id, text): every row in a range of keys, and once more, marked ``ahead``, at
    the end of the range before it if it is a range's first; the first range follows the last.

    A key is the id and a checksum of the text, so that rows of one id are cut into ranges too;
    ranges are found from sampled keys, whatever the distribution of ids."""
    spark = docs.sparkSession
    p = partitions(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = columns_of(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("h"))
    keys = rows.select(F.col("id").isNotNull().cast("int").alias("some"), "id", "h")
    borders = _borders(keys, keys.count(), RANGES * p)
    bucket = _bucket_of(borders)(F.col("id").isNotNull().cast("int"), F.coalesce("id", F.lit(0).cast("long")), F.col("h"))
    rows = rows.withColumn("bucket", bucket)
    first = F.min(F.struct(F.col("id").isNotNull().alias("some"), "id", "h")).alias("f")
    firsts = {r["bucket"]: (r["f"]["id"], r["f"]["h"]) for r in rows.groupBy("bucket").agg(first).collect()}  # RANGES * p at most
    order = sorted(firsts)
    known = spark.createDataFrame([(b, *firsts[b], order[i - 1]) for i, b in enumerate(order)], "b int, first long, first_h long, before int")
    own = F.struct(F.col("bucket"), F.lit(False).alias("ahead"))
    both = F.when(
        F.col("id").eqNullSafe(F.col("first")) & (F.col("h") == F.col("first_h")), F.array(own, F.struct(F.col("before").alias("bucket"), F.lit(True).alias("ahead")))
    ).otherwise(F.array(own))
    placed = (
        rows.join(F.broadcast(known), F.col("bucket") == F.col("b"))
        .select("id", "text", "h", F.explode(both).alias("place"))
        .select("place.bucket", "place.ahead", "id", "text", "h")
    )
    # Ranges hold about the same number of rows, and each partition the same number of ranges.
    dealt = placed.repartitionById(p, (F.col("bucket") % p).cast("int"))
    return dealt.sortWithinPartitions("bucket", "ahead", F.col("id").asc_nulls_first(), "h", "text").drop("h")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5) -> DataFrame:
    """One row per input row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    A null text counts as empty; a text without words has the empty fingerprint, which is like
    itself and unlike any other. A text of fewer than ``k`` words has one shingle. Rows follow each
    other by id, null ids first, equal ids by a checksum of the text and then the text; after the last comes the first, so that a
    single row follows itself. An empty table gives an empty result; columns other than the two
    named are not read.
    """
    schema = (
        f"{id_col} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )
    return with_next(docs, id_col, text_col).mapInArrow(_compare(k, [x.split()[0] for x in schema.split(", ")]), schema)
