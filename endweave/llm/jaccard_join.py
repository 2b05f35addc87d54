"""N-gram Jaccard self-join: which documents share at least a given part of their shingles.

1. Documents with equal shingle sets form a class, represented by the smallest id.
2. Two classes that link differ in few shingles, at most H of those of both. Shingles are dealt to
   H + need parts by their hash: at least ``need`` parts are the same in both, with no loss. A part
   is one token, the hash of all its shingles, so that common phrases or passages alone make no
   candidates. Classes with fewer tokens in common with others than ``need`` have no partner; of the
   others the rarest tokens suffice, and classes with one in common form a neighbourhood.
3. Inside a neighbourhood a signature tree finds the links exactly, over whole shingle sets, and
   leaves out what is linked already. A large neighbourhood is dealt to blocks. Each member is
   compared in its own block first; then, round by round, one member of each cluster found so far
   with those of the others, which joins a family of near copies. Only where clusters are left
   apart are members compared once more, those outside the largest cluster with all.
4. Links give components.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from endweave.llm.common import columns_of, cut, dealt_anew, nearby, partitions
from endweave.llm.components import components
from endweave.llm.signature_tree import linked
from endweave.llm.wordhash import mix64, shingle_sets

#: A block of a large neighbourhood: so many classes or shingles at most on average.
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 2_000_000
#: A token is frequent if it occurs in one of HOT_SHARE documents; it is looked for in one of
#: HOT_SAMPLE documents, where it must occur HOT_LEAST times.
HOT_SHARE, HOT_SAMPLE, HOT_LEAST = 1000, 64, 64

_SALT = np.uint64(0xC2B2AE3D27D4EB4F)


class Parts:
    """How sets are dealt to parts, by bands of their size.

    Sets of one band that link share the band's scheme. Where a set and a partner may lie on both
    sides of a border between bands, they share the border's scheme. Bands are so wide that a set
    is near one border at most, but for rounding.
    """

    WIDE = 2  # sets of a band differ in size by this power of the least ratio of linked sets

    def __init__(self, percent: int):
        self.percent = percent
        self.lows = [1]

    def band(self, n: int) -> int:
        while self.lows[-1] <= n + n * 100 // self.percent + 1:
            low = self.lows[-1]
            for _ in range(self.WIDE):
                low = -(-100 * low // self.percent)
            self.lows.append(max(self.lows[-1] + 1, low))
        return bisect_right(self.lows, n) - 1

    def schemes(self, n: int) -> list[tuple[int, int]]:
        """(number of the scheme, shingles in which two linked sets of it differ at most)."""
        own = self.band(n)
        bound = lambda both: both * (100 - self.percent) // (100 + self.percent)
        out = [(3 * own, bound(2 * (self.lows[own + 1] - 1)))]
        low, high = self.lows[own], self.lows[own + 1]
        if own and -(-self.percent * n // 100) < low:
            out.append((3 * own - 2, bound(low - 1 + 100 * (low - 1) // self.percent)))
        if 100 * n // self.percent >= high:
            out.append((3 * own + 1, bound(high - 1 + 100 * (high - 1) // self.percent)))
        return out

    @staticmethod
    def tokens(values: np.ndarray, scheme: int, h: int) -> tuple[np.ndarray, int]:
        """(tokens, how many of them a partner has at least) of a set of shingles."""
        if h == 0:  # only equal sets link
            return np.zeros(0, dtype=np.uint64), 1
        least = 1 + h // 8
        n = h + least
        mixed = mix64(values + np.uint64(scheme))
        part = ((mixed >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
        total = np.zeros(n, dtype=np.uint64)
        np.add.at(total, part, mix64(mixed + _SALT))
        filled = np.bincount(part, minlength=n)
        # Empty parts say little: they are left out unless so many are empty that two sets might
        # have no other part in common.
        full = np.flatnonzero(filled)
        if n - len(full) < least:
            least -= n - len(full)
            at = full
        else:
            least, at = 1, np.arange(n)
        return mix64(total[at] + mix64(at.astype(np.uint64) * _SALT + np.uint64(scheme))), least


def _fingerprint(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _sketch(k: int):
    """(id, n, fp) of rows (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints = [], []
            for _, values in shingle_sets(batch.column(1), k):
                sizes.append(len(values))
                prints.append(_fingerprint(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary())], names=["id", "n", "fp"])

    return run


def _tokens(k: int, percent: int):
    """(node, meta, tokens) of rows (id, text): a row for each scheme of a document; meta holds how
    many tokens a partner shares at least, and the scheme's ordinal, 0 to 2, in its lowest two bits."""

    def out(rows: list[tuple]) -> pa.RecordBatch:
        ends = np.concatenate([[0], np.cumsum([len(r[2]) for r in rows])]).astype(np.int32)
        flat = np.concatenate([r[2] for r in rows]) if rows else np.zeros(0, dtype=np.int64)
        tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), tokens], names=["node", "meta", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Parts(percent)
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for i, values in shingle_sets(batch.column(1), k):
                for side, scheme in enumerate(parts.schemes(len(values)) if len(values) else []):
                    found, least = parts.tokens(values, *scheme)
                    if len(found):
                        rows.append((ids[i], 4 * least + side, found.view(np.int64)))
                if len(rows) >= 1000:
                    yield out(rows)
                    rows = []
            yield out(rows)

    return run


def _verify(k: int, percent: int):
    """Rows (g, part, side, node, fp, text) sorted by (g, part): stars of the links in each run; in a
    run of both sides only those across."""

    def links(run: dict) -> tuple[list, list]:
        nodes, sets, sides = zip(*run.values(), strict=True)
        label = linked(list(sets), np.array(sides), percent)
        least: dict[int, int] = {}
        for node, at in zip(nodes, label, strict=True):
            least[at] = min(node, least.get(at, node))
        pairs = [(node, least[at]) for node, at in zip(nodes, label, strict=True) if node != least[at]]
        return [u for u, _ in pairs], [v for _, v in pairs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, {}

        def out(us: list, vs: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

        for batch in batches:
            g, part, side, node = (batch.column(i).to_pylist() for i in range(4))
            prints = batch.column(4).to_pylist()
            us, vs = [], []
            for i, values in shingle_sets(batch.column(5), k):
                if (g[i], part[i]) != key:
                    if len(held) > 1:
                        found = links(held)
                        us += found[0]
                        vs += found[1]
                    key, held = (g[i], part[i]), {}
                # Rows that have a class's id but not its shingles are other rows with that id.
                if _fingerprint(values) == prints[i]:
                    held[(node[i], prints[i])] = (node[i], values, side[i])
            yield out(us, vs)
        if len(held) > 1:
            yield out(*links(held))

    return run


def _frequent(docs: DataFrame, make, schema: str) -> DataFrame:
    """(hot, about how many documents have it) of frequent tokens, from a part of the documents
    (id, text). They are some HOT_SHARE times the tokens of a document at most. Only how rows are
    dealt out depends on what is found."""
    drawn = docs.filter(F.pmod(F.xxhash64("id", F.lit(9)), F.lit(HOT_SAMPLE)) == 0)
    least = max(HOT_LEAST, drawn.count() // HOT_SHARE)
    counts = drawn.mapInArrow(make, schema).select(F.explode("tokens").alias("hot")).groupBy("hot").agg(F.count(F.lit(1)).alias("n"))
    return cut(counts.filter(F.col("n") >= least).select("hot", (F.col("n") * HOT_SAMPLE).alias("about")))


def _neighbourhoods(tokens: DataFrame, frequent: DataFrame) -> DataFrame:
    """(node, label) of the nodes (node, meta, token) that may have a partner."""
    same = F.count(F.lit(1)).over(Window.partitionBy("token"))
    if not frequent.limit(1).count():
        rows = tokens.withColumn("df", same).filter("df > 1")
    else:
        # Rarest tokens first needs the same order everywhere, not exact counts: those of frequent
        # tokens, whose rows are spread, are estimates.
        # ``spread`` is 0, or the order of magnitude in its lowest six bits and a share of the rows above.
        share = F.pmod(F.xxhash64("node"), F.greatest(F.ceil(F.col("about") / 10_000), F.lit(2)))
        spread = F.coalesce(F.shiftleft(share, 6).bitwiseOR(F.ceil(F.log2("about")).cast("long")), F.lit(0).cast("long"))
        rows = tokens.join(nearby(frequent), F.col("token") == F.col("hot"), "left").select("node", "meta", "token", spread.alias("spread"))
        rows = rows.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("token", "spread"))).filter("df > 1 or spread > 0")
        rows = rows.withColumn("df", F.when(F.col("spread") == 0, F.col("df")).otherwise(F.expr("shiftleft(1L, cast(spread & 63L AS int))")))
    shared = (
        rows.groupBy("node", "meta")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
        .withColumn("need", F.shiftright("meta", 2))
        .filter(F.size("shared") >= F.col("need"))
    )
    kept = cut(shared.select("node", F.explode(F.expr("slice(shared, 1, size(shared) - need + 1)")["token"]).alias("token")))
    hubs = kept.groupBy("token").agg(F.min("node").alias("hub"))
    return components(kept.join(dealt_anew(hubs, "token"), "token").select(F.col("node").alias("u"), F.col("hub").alias("v")))


def _blocks(members: DataFrame, by: str) -> DataFrame:
    """(by, blocks, clusters): how many blocks the members (by, n) of each group are dealt to, and their number."""
    per = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    return members.groupBy(by).agg(per.alias("blocks"), F.count(F.lit(1)).alias("clusters"))


def _links(rows: DataFrame, members: DataFrame, k: int, percent: int) -> DataFrame:
    """Edges among members (g, parts, side, node, fp), each in its ``parts`` of g; rows: (id, text)."""
    dealt = rows.join(nearby(members), F.col("id") == F.col("node")).select("g", F.explode("parts").alias("part"), "side", "node", "fp", "text")
    return (
        dealt.repartition(partitions(rows.sparkSession), "g", "part")
        .sortWithinPartitions("g", "part")
        .mapInArrow(_verify(k, percent), "u long, v long")
    )


def _within(rows: DataFrame, members: DataFrame, by: str, k: int, percent: int) -> DataFrame:
    """Edges among the members (by, blocks, node, fp) of each group that lie in the same block of it."""
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("long")
    return _links(rows, cut(members.select(F.col(by).alias("g"), F.array(block).alias("parts"), F.lit(0).alias("side"), "node", "fp")), k, percent)


def _clustered(members: DataFrame, edges: DataFrame, column: str) -> DataFrame:
    """The members with the least node that edges lead to from ``column``, in place of it."""
    label = components(edges).select(F.col("node").alias("of"), F.col("label").alias("to"))
    joined = members.join(label, F.col(column) == F.col("of"), "left")
    return joined.withColumn(column, F.coalesce("to", column)).drop("of", "to")


def _across(rows: DataFrame, members: DataFrame, k: int, percent: int) -> DataFrame:
    """Edges that may be missing between the clusters of large neighbourhoods: of all members
    (label, cluster, n, node, fp) of one that has several, those outside its largest cluster with
    those in it, block by block, and with each other."""
    sizes = members.groupBy("label", "cluster").agg(F.count(F.lit(1)).alias("many"))
    main = sizes.groupBy("label").agg(F.max(F.struct("many", "cluster"))["cluster"].alias("main"), F.count(F.lit(1)).alias("clusters"))
    main = main.filter("clusters > 1").select(F.col("label").alias("g"), "main")
    apart = cut(members.join(main, F.col("label") == F.col("g")).withColumn("side", (F.col("cluster") != F.col("main")).cast("int")))
    counts = apart.groupBy("g").agg(
        *[
            F.greatest(
                F.ceil(F.count(F.when(F.col("side") == s, 1)) / BLOCK_ROWS), F.ceil(F.coalesce(F.sum(F.when(F.col("side") == s, F.col("n"))), F.lit(0)) / BLOCK_SHINGLES)
            ).cast("long").alias(name)
            for s, name in ((0, "within"), (1, "strays"))
        ]
    )
    dealt = apart.join(counts.withColumnRenamed("g", "h"), F.col("g") == F.col("h"))
    own = F.pmod(F.xxhash64("node", F.lit(5)), F.when(F.col("side") == 0, F.col("within")).otherwise(F.col("strays"))).cast("long")
    other = F.when(F.col("side") == 0, F.col("strays")).otherwise(F.col("within"))
    dealt = dealt.withColumn("own", own).withColumn("other", other)
    met = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("other") - 1), lambda o: F.when(F.col("side") == 0, F.col("own") * F.col("strays") + o).otherwise(o * F.col("strays") + F.col("own"))
    )
    with_main = cut(dealt.select("g", met.alias("parts"), "side", "node", "fp"))
    pair = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("strays") - 1), lambda o: F.least(F.col("own"), o) * F.col("strays") + F.greatest(F.col("own"), o)
    )
    # Two blocks of strays are compared whole, which finds links inside a block more than once.
    strays = cut(dealt.filter("side = 1").select("g", pair.alias("parts"), F.lit(0).alias("side"), "node", "fp"))
    return _links(rows, with_main, k, percent).union(_links(rows, strays, k, percent))


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    Words are split at ASCII white space, A-Z count as a-z; a document's set are its distinct k-word
    shingles, or all its words as one if they are fewer. Documents link when 100 times the common
    shingles are at least ``percent`` times all of both; component_id is the smallest id that links
    reach. A null text counts as empty; empty documents link with nothing and have their own id.

    Rows with the same id are one node if they share a class's smallest id. Rows without an id
    belong to the component of their shingle set, which is null where no row of it has an id. An
    empty table gives an empty result; columns other than the two named are not read. Shingles are
    compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    p = partitions(spark)
    rows = columns_of(docs, id_col, text_col).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketch = cut(rows.mapInArrow(_sketch(k), "id long, n long, fp binary"))
    classes = cut(
        sketch.filter("n > 0").groupBy("fp").agg(F.min("id").alias("node"), F.first("n").alias("n")).filter("node is not null")
    )
    # Whole classes but for their nodes need no tokens; their texts are left out where they are read.
    first = classes.select(F.col("node").alias("id"), F.lit(True).alias("first")).distinct()
    others = sketch.filter("id is not null").select("id").distinct().join(first, "id", "left_anti")
    alone = rows.filter("id is not null").join(nearby(cut(others)), "id", "left_anti")
    make, schema = _tokens(k, percent), "node long, meta int, tokens array<long>"
    tokens = alone.mapInArrow(make, schema).select("node", "meta", F.explode("tokens").alias("token"))
    near = _neighbourhoods(tokens, _frequent(alone, make, schema))
    members = classes.select("node", "fp", "n").join(near, "node")
    blocks = _blocks(members, "label").withColumnRenamed("label", "l").drop("clusters")
    members = cut(members.join(blocks, F.col("label") == F.col("l")).drop("l"))
    # The texts of members are read again and again: once and for all the others are left behind.
    texts = cut(rows.join(nearby(cut(members.select(F.col("node").alias("m")).distinct())), F.col("id") == F.col("m"), "left_semi"))
    links = cut(_within(texts, members, "label", k, percent))
    large = members.filter("blocks > 1").withColumn("cluster", F.col("node"))
    if large.limit(1).count():
        large = cut(_clustered(large, links, "cluster").drop("blocks"))
        opened = None
        while True:
            first = large.filter("node = cluster")
            per = _blocks(first, "label").withColumnRenamed("label", "l")
            if opened is not None:  # another round where the last one left half of the clusters at most
                per = per.join(opened, F.col("l") == F.col("o")).filter("clusters * 2 <= was").drop("o", "was")
            per = cut(per.filter("clusters > 1"))
            if not per.limit(1).count():
                break
            first = first.join(per, F.col("label") == F.col("l")).drop("l", "clusters")
            more = cut(_within(texts, first, "label", k, percent))
            large = cut(_clustered(large, more, "cluster"))
            links = links.union(more)
            opened = per.filter("blocks > 1").select(F.col("l").alias("o"), F.col("clusters").alias("was"))
        links = links.union(cut(_across(texts, large, k, percent)))
    label = components(links)
    named = classes.select("fp", "node").join(label, "node", "left").select("fp", F.coalesce("label", "node").alias("component"))
    return sketch.join(named, "fp", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component_id"),
    )
