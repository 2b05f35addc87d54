"""Interval algebra: binned range joins, island merging, gap clustering, sweeps and coverage."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from endweave.session import cut, written

#: Width of the bins of range joins, for genes, for components and for sites, and of the tiles of sweeps, of rows,
#: of windows and of arrays.
BIN, FINE, SITE, TILE, STRIP, BLOCK = 100_000, 1024, 64, 1 << 20, 1 << 12, 1 << 14
#: Rows that are swept as arrays at a time.
SWEPT = 1 << 19


def bins(start: Column, end: Column, width: int) -> Column:
    """The bins that [start, end) touches; an empty interval touches its start's."""
    return F.sequence(F.floor(start / width), F.floor(F.greatest(start, end - 1) / width))


def points_in(
    points: DataFrame, spans: DataFrame, keys: list[str], pos: str, start: str, end: str, how: str = "inner", width: int = BIN
) -> DataFrame:
    """Joins points to the intervals [start, end) that hold them, by equal keys and bins: the intervals
    are dealt to bins, points have one each, so that no pair appears twice. ``how`` is inner or
    left_semi. Columns other than the keys must differ."""
    dealt = spans.withColumn("bin", F.explode(bins(F.col(start), F.col(end), width))).alias("spans")
    at = points.withColumn("bin", F.floor(F.col(pos) / width)).alias("points")
    on = [F.col(f"points.{k}") == F.col(f"spans.{k}") for k in ["bin", *keys]]  # sorted by bins first, which tell rows apart where keys are few
    on += [F.col(f"points.{pos}") >= F.col(f"spans.{start}"), F.col(f"points.{pos}") < F.col(f"spans.{end}")]
    joined = at.join(dealt, on, how)
    kept = [F.col(f"points.{c}") for c in points.columns]
    if how == "inner":
        kept += [F.col(f"spans.{c}") for c in spans.columns if c not in keys]
    return joined.select(*kept)


def overlaps(a: DataFrame, b: DataFrame, keys: list[str], width: int = BIN, prefix: str = "o_") -> DataFrame:
    """Pairs of overlapping intervals (columns start, end), each in the bin where the later one starts;
    b's columns, but for the keys, get the prefix."""
    left = a.withColumn("bin", F.explode(bins(F.col("start"), F.col("end"), width))).alias("a")
    right = b.withColumn("bin", F.explode(bins(F.col("start"), F.col("end"), width))).alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ["bin", *keys]]  # sorted by bins first, which tell rows apart where keys are few
    on += [F.col("a.start") < F.col("b.end"), F.col("b.start") < F.col("a.end")]
    on.append(F.col("a.bin") == F.floor(F.greatest("a.start", "b.start") / width))
    return left.join(right, on).select(
        *[F.col(f"a.{c}") for c in a.columns], *[F.col(f"b.{c}").alias(prefix + c) for c in b.columns if c not in keys]
    )


def tiled(df: DataFrame, keys: list[str], pos: str, tile: int = TILE) -> DataFrame:
    """The rows with ``tile_``, a struct of keys and number of the tile of ``tile`` positions, which null
    keys and a null position are part of; rows of a tile lie together.

    The one exchange of a sweep: all that is worked out for tiles, or carried to them, reads it again."""
    at = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.floor(F.col(pos) / tile).alias("tile"))
    return df.withColumn("tile_", at).repartition("tile_")


def carried(df: DataFrame, before: dict | None = None, after: dict | None = None) -> DataFrame:
    """Adds to the rows of a tile what the tiles of the same keys before or after it add up to.

    before, after: name -> (aggregate of a tile's rows, function that combines those of other tiles),
    null where there are no others. One row a tile is all that is ordered across tiles."""
    before, after = before or {}, after or {}
    per = df.groupBy("tile_").agg(*[agg.alias(name) for name, (agg, _) in {**before, **after}.items()])
    keys = [F.col(f"tile_.{f.name}") for f in df.schema["tile_"].dataType.fields[:-1]]
    number = F.col("tile_.tile")
    up = Window.partitionBy(*keys).orderBy(number.asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*keys).orderBy(number.desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    over = [combine(name).over(up).alias(name) for name, (_, combine) in before.items()]
    over += [combine(name).over(down).alias(name) for name, (_, combine) in after.items()]
    # Structs with null fields are equal where their fields are, so that no row is lost.
    return df.join(per.select("tile_", *over), "tile_")


def merge(spans: DataFrame, keys: list[str], adjacent: bool = False, tile: int = TILE, most: str | None = None) -> DataFrame:
    """Islands of overlapping (or touching) non-empty intervals: keys, start, end, members, and the largest value of
    the column ``most``, if there is one.

    Intervals are swept in tiles of starts: a tile knows the reach of those before, its first island the
    start of the one that it goes on with. Rows without a start or an end are no intervals; a null key is
    a key."""
    rows = carried(tiled(spans.filter("end > start"), keys, "start", tile), {"reach_": (F.max("end"), F.max)})
    order = Window.partitionBy("tile_").orderBy("start", "end")
    reach = F.greatest("reach_", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    apart = F.col("start") > reach if adjacent else F.col("start") >= reach
    marked = rows.withColumn("begins_", F.when(F.coalesce(apart, F.lit(True)), F.col("start")))
    marked = marked.withColumn("own_", F.max("begins_").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    best = [F.max(most).alias(most)] if most else []
    parts = marked.groupBy("tile_", *keys, "own_").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("members"), *best)
    parts = carried(parts, {"island_": (F.max("own_"), F.max)}).withColumn("island", F.coalesce("own_", "island_"))
    return (
        parts.groupBy(*keys, "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("members").alias("members"), *best)
        .drop("island")
    )


def gap_clusters(points: DataFrame, keys: list[str], pos: str, gap: int, tile: int = TILE) -> DataFrame:
    """Adds ``cluster``: a number that rises where a position is more than ``gap`` behind the one before.

    Positions are swept in tiles, each with the last position and the clusters of those before. Rows
    without a position come first and are in the first cluster; a null key is a key."""
    rows = carried(tiled(points, keys, pos, tile), {"last_": (F.max(pos), F.max)})
    order = Window.partitionBy("tile_").orderBy(pos)
    new = F.coalesce(F.col(pos) - F.coalesce(F.lag(pos).over(order), F.col("last_")) > gap, F.lit(False)).cast("int")
    marked = carried(rows.withColumn("new", new), {"clusters_": (F.sum("new"), F.sum)})
    upto = F.sum("new").over(order.rangeBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("cluster", F.coalesce("clusters_", F.lit(0)) + upto).select(*points.columns, "cluster")


def window_components(points: DataFrame, keys: list[str], width: int, threshold: Column, tile: int = STRIP, wide: int = TILE) -> DataFrame:
    """What windows of ``width`` positions cover whose sum of ``value`` (pos, value) exceeds the
    threshold, as merged intervals. Values are not negative.

    A window is known by its start; a point adds to the starts in [pos - width + 1, pos]. Tiles of
    starts are swept each for itself, so that the parallelism is not that of the keys; they are narrow, and
    come first in the order, as rows of a few keys are sorted by their numbers then. Where a window exceeds the
    threshold, so do that which ends at its last point and that which begins at its first one, and these two
    cover it: a row a point is all that is swept.
    """
    # One exchange, of points: windows and islands of a tile are all worked out where they lie.
    dealt = _tiles(points, keys, width, tile).repartition("tile", *keys)
    order = Window.partitionBy("tile", *keys).orderBy("pos")
    back = F.sum("value").over(order.rangeBetween(1 - width, 0)) > threshold
    ahead = F.sum("value").over(order.rangeBetween(0, width - 1)) > threshold
    found = dealt.select(*keys, "tile", "pos", back.alias("back"), ahead.alias("ahead")).filter("back or ahead")
    parts = _strip_islands(found, keys, width)
    # Written once, as the sweep across tiles reads them again and again.
    return merge(cut(parts.select(*keys, "start", "end")), keys, adjacent=True, tile=max(tile, wide)).drop("members")


def window_summits(points: DataFrame, keys: list[str], width: int, threshold: Column, tile: int = BLOCK, wide: int = TILE) -> DataFrame:
    """As ``window_components``, with ``summit``: the place in the interval where ``value``, a whole number, adds up
    to most, the lowest one of ties. Points of one place are summed.

    A component holds the points of its windows and no others, so that its highest place is found in the sweep that
    finds it. Strips lie together and in order in a task, which sweeps some SWEPT rows of them at a time."""
    limit = points.sparkSession.range(1).select(threshold.alias("limit")).first()["limit"]
    limit = math.floor(limit)  # whole sums exceed the one where they exceed the other
    types = {f.name: f.dataType.simpleString() for f in points.schema.fields}

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_strips(batches, "strip_", SWEPT):
            # Strips one behind the other, further apart than a window is wide.
            code = np.zeros(len(table), dtype=np.int64)
            for k in [*keys, "tile"]:
                index = table[k].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
                code = np.unique(code * (int(index.max()) + 1) + index, return_inverse=True)[1]
            _, some = np.unique(code, return_index=True)
            at = code * (tile + 3 * width) - table["tile"].to_numpy() * tile
            start, end, value, summit = strip_summits(table["pos"].to_numpy() + at, table["value"].to_numpy(), width, limit)
            row = some[(start + 2 * width) // (tile + 3 * width)]
            told = [table[k].combine_chunks().take(pa.array(row)) for k in keys]
            yield from pa.table([*told, *[pa.array(v) for v in (start - at[row], end - at[row], value, at[row] - summit)]], names=[*keys, "start", "end", "value", "down"]).to_batches()

    dealt = _tiles(points.select(*keys, "value", F.col("pos").cast("long").alias("pos")), keys, width, tile)
    dealt = dealt.withColumn("strip_", F.xxhash64("tile", *keys)).repartition("strip_").sortWithinPartitions("strip_")
    schema = ", ".join([*[f"{k} {types[k]}" for k in keys], "start long, end long, value long, down long"])
    # Written once, as the sweep across tiles reads them again and again.
    parts = written(dealt.mapInArrow(swept, schema).select(*keys, "start", "end", F.struct("value", "down").alias("best")))
    return merge(parts, keys, adjacent=True, tile=max(tile, wide), most="best").select(*keys, "start", "end", (-F.col("best.down")).alias("summit"))


def whole_strips(batches: Iterator[pa.RecordBatch], key: str, rows: int) -> Iterator[pa.Table]:
    """Sorted batches as tables of some ``rows`` rows, cut where the key changes."""
    held, count = [], 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held)
        strip = table[key].to_numpy()
        upto = int(np.flatnonzero(strip != strip[-1])[-1]) + 1 if strip[0] != strip[-1] else 0
        if upto:
            yield table.slice(0, upto)
        rest = table.slice(upto)
        held, count = rest.to_batches(), len(rest) if upto else 0
    if held:
        yield pa.Table.from_batches(held)


def strip_summits(pos: np.ndarray, value: np.ndarray, width: int, limit: int) -> tuple[np.ndarray, ...]:
    """(starts, ends, heights, summits) of the islands of a strip's windows that exceed the limit."""
    order = np.argsort(pos, kind="stable")
    pos, value = pos[order], value[order]
    first = np.flatnonzero(np.r_[True, pos[1:] != pos[:-1]])
    pos, value = pos[first], np.add.reduceat(value, first)
    upto = np.r_[0, np.cumsum(value)]
    back = upto[1:] - upto[np.searchsorted(pos, pos - (width - 1))] > limit
    ahead = upto[np.searchsorted(pos, pos + width)] - upto[:-1] > limit
    found = back | ahead
    if not found.any():
        return tuple(np.zeros((4, 0), dtype=np.int64))
    x, reach = np.where(back, pos - (width - 1), pos)[found], np.where(ahead, pos + width, pos + 1)[found]
    # An island that a later window joins to the one before stays cut in two here, for the merge to join.
    cuts = np.flatnonzero(np.r_[True, x[1:] > np.maximum.accumulate(reach)[:-1]])
    start, end = np.minimum.reduceat(x, cuts), np.maximum.reduceat(reach, cuts)
    low, high = np.searchsorted(pos, start), np.searchsorted(pos, end)
    size = high - low
    island = np.repeat(np.arange(len(start)), size)
    held = np.arange(size.sum()) + np.repeat(low - np.r_[0, np.cumsum(size)[:-1]], size)
    top = np.maximum.reduceat(value[held], np.r_[0, np.cumsum(size)[:-1]])
    best = np.flatnonzero(value[held] == top[island])
    _, lowest = np.unique(island[best], return_index=True)
    return start, end, top, pos[held[best[lowest]]]


def _tiles(points: DataFrame, keys: list[str], width: int, tile: int) -> DataFrame:
    """Points (keys, tile, pos, value) in the strips of the starts of the windows that hold them."""
    first = F.col("pos") - (width - 1)
    dealt = points.withColumn("tile", F.explode(F.sequence(F.floor(first / tile), F.floor(F.col("pos") / tile))))
    return dealt.select(*keys, "tile", "pos", "value")


def _strip_islands(found: DataFrame, keys: list[str], width: int) -> DataFrame:
    """(keys, start, end) of what the windows that end or begin at the found points cover (back, ahead)."""
    order = Window.partitionBy("tile", *keys).orderBy("pos")
    covered = found.select(
        *keys, "tile", "pos", F.when(F.col("back"), F.col("pos") - (width - 1)).otherwise(F.col("pos")).alias("x"), F.when(F.col("ahead"), F.col("pos") + width).otherwise(F.col("pos") + 1).alias("reach")
    )
    # An island that a later window joins to the one before stays cut in two here, for the merge to join.
    apart = F.coalesce(F.col("x") > F.max("reach").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    islands = covered.withColumn("begins", F.when(apart, F.col("pos"))).withColumn("island", F.max("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy("tile", *keys, "island").agg(F.min("x").alias("start"), F.max("reach").alias("end"))


def coverage(spans: DataFrame, keys: list[str], tile: int = TILE) -> DataFrame:
    """Runs of equal depth above zero: keys, start, end, depth; swept in tiles that know the depth they
    begin with and where the next one begins. Rows without a start or an end cover nothing; a null key is
    a key."""
    whole = spans.filter("start is not null and end is not null")
    events = whole.select(*keys, F.explode(F.array(F.struct(F.col("start").alias("x"), F.lit(1).alias("d")), F.struct(F.col("end").alias("x"), F.lit(-1).alias("d")))).alias("e"))
    steps = events.groupBy(*keys, F.col("e.x").alias("x")).agg(F.sum("e.d").alias("d")).filter("d <> 0")
    steps = carried(tiled(steps, keys, "x", tile), {"depth_": (F.sum("d"), F.sum)}, {"next_": (F.min("x"), F.min)})
    order = Window.partitionBy("tile_").orderBy("x")
    depth = F.coalesce("depth_", F.lit(0)) + F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0))
    runs = steps.withColumn("depth", depth).withColumn("end", F.coalesce(F.lead("x").over(order), F.col("next_")))
    return runs.filter("depth > 0").select(*keys, F.col("x").alias("start"), "end", "depth")


def nearest_distance(points: DataFrame, sites: DataFrame, keys: list[str], pos: str = "pos", site: str = "site", tile: int = TILE) -> DataFrame:
    """Adds ``distance`` to the nearest site of the same keys, null without one or without a position; swept
    in tiles that know the last site before and the first one behind them. A null key is a key."""
    both = points.select(*keys, F.col(pos).alias("at"), F.lit(None).cast("long").alias("known"), F.struct(*points.columns).alias("row")).unionByName(
        sites.select(*keys, F.col(site).alias("at"), F.col(site).cast("long").alias("known")), allowMissingColumns=True
    )
    both = carried(tiled(both, keys, "at", tile), {"before_": (F.max("known"), F.max)}, {"after_": (F.min("known"), F.min)})
    order = Window.partitionBy("tile_").orderBy("at")
    before = F.coalesce(F.last("known", ignorenulls=True).over(order.rangeBetween(Window.unboundedPreceding, 0)), F.col("before_"))
    # Downwards as a running frame too: one that is open at its far end is read anew for every row.
    down = Window.partitionBy("tile_").orderBy(F.col("at").desc())
    after = F.coalesce(F.last("known", ignorenulls=True).over(down.rangeBetween(Window.unboundedPreceding, 0)), F.col("after_"))
    return (
        both.withColumn("distance", F.least(F.abs(F.col("at") - before), F.abs(after - F.col("at"))))
        .filter("row is not null")
        .select("row.*", "distance")
    )
