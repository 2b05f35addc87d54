"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the one nearest to 1 in relative entropy under two conditions: the
taken words of each source meet the source's target, and no rate exceeds ``max_copies``. The
rates are exponentially tilted, ``min(max_copies, exp(lambda * size))``, with one multiplier a
source, the root of the dual's gradient, found by Newton steps inside a bracket. Rates become
whole copies by cumulative rounding in the order of size, and a few single copies of well-fitting
documents close what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from endweave.llm.common import WORD, columns_of, cut, partitions, text_or_empty

#: Newton steps at most, those between two looks at the error, the relative error at which they end,
#: the error that is too large after all steps, and the single copies that may close a gap.
STEPS, AT_ONCE, TOLERANCE, LOOSE, SINGLES = 64, 4, 1e-9, 1e-4, 12


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, size): weights go round by the code-point order
    of the sources, null last; targets share the total, and stop at ``most`` times the source."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    index = (F.row_number().over(order) - 1) % len(weights)
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (index + 1).cast("int")))
    per = per.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    # Sources fill up in the order of cap over weight: the first that stays below its cap at the
    # level of those behind it fixes the level for all of them.
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    whole = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before, behind = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(behind)
    per = per.withColumn("level", level).withColumn(
        "fixed", F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "level"))).over(whole)["level"]
    )
    target = F.least(F.col("cap"), F.coalesce("fixed", F.lit(0.0)) * F.col("w"))
    return per.select("source", "source_size", target.alias("target"))


def _rate(multiplier: Column, most: int) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.least(multiplier * F.col("a"), F.lit(700.0))))


def _exact_sum(term: Column) -> Column:
    """A sum that does not depend on the order of its terms, so that reruns agree to the last bit."""
    return F.sum(term.cast("decimal(38,12)")).cast("double")


def _step(cells: DataFrame, state: DataFrame, most: int) -> DataFrame:
    """The state after one Newton step of every source, or half its bracket where Newton leaves it."""
    given = [F.col(f"s.{c}").alias(c) for c in ("source_size", "target", "lo", "hi", "lam")]
    held = cells.alias("c").join(state.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).select(
        F.col("c.source").alias("source"), "size", "n", "a", *given
    )
    rate = _rate(F.col("lam"), most)
    sums = held.groupBy("source").agg(
        *[F.first(c).alias(c) for c in ("source_size", "target", "lo", "hi", "lam")],
        _exact_sum(F.col("n") * F.col("size") * rate).alias("taken"),
        _exact_sum(F.when(rate < most, F.col("n") * F.col("size") * F.col("a") * rate).otherwise(0.0)).alias("slope"),
    )
    gap = F.col("taken") - F.col("target")
    moved = (
        sums.withColumn("gap", gap)
        .withColumn("error", F.abs("gap") / F.col("source_size"))
        .withColumn("lo", F.when(F.col("gap") <= 0, F.col("lam")).otherwise(F.col("lo")))
        .withColumn("hi", F.when(F.col("gap") >= 0, F.col("lam")).otherwise(F.col("hi")))
        .withColumn("newton", F.col("lam") - F.try_divide(F.col("gap"), F.col("slope")))
    )
    inside = (F.col("slope") > 0) & (F.col("newton") > F.col("lo")) & (F.col("newton") < F.col("hi"))
    lam = F.when(F.col("error") <= TOLERANCE, F.col("lam")).when(inside, F.col("newton")).otherwise((F.col("lo") + F.col("hi")) / 2)
    return moved.select("source", "source_size", "target", "lo", "hi", lam.alias("lam"), "error")


def _solve(cells: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """(source, lam) for (source, size, n) cells: the root of sum n * size * rate = target.

    A step needs one exchange of a row for each source and task. Raises if a source's multiplier
    is not found within STEPS steps."""
    cells = cells.join(targets, cells.source.eqNullSafe(targets.source)).select(
        cells.source, "size", "n", (F.col("size") / F.col("mean")).alias("a")
    )
    cells = cut(cells.filter("size > 0"))
    log_most = F.log(F.lit(float(most)))
    least_a = F.lit(1.0) / F.col("mean")
    ratio = F.col("target") / F.col("source_size")
    state = targets.filter("source_size > 0").select(
        "source",
        "source_size",
        "target",
        F.when(ratio < 1, F.log(F.greatest(ratio, F.lit(1e-300))) / least_a).otherwise(0.0).alias("lo"),
        F.when(ratio > 1, log_most / least_a).otherwise(0.0).alias("hi"),
    )
    state = state.withColumn("lam", F.lit(0.0)).withColumn("error", F.lit(1.0))
    for _ in range(STEPS // AT_ONCE):
        for _ in range(AT_ONCE):
            state = _step(cells, state, most)
        state = cut(state)
        worst = state.agg(F.max("error")).first()[0]
        if worst is None or worst <= TOLERANCE:
            return state.select("source", "lam")
    if worst > LOOSE:
        raise ArithmeticError(f"no multiplier was found in {STEPS} steps; the words taken miss a target by {worst:.3g} of the source")
    return state.select("source", "lam")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken, copies, rate.

    ``size`` is the number of words, 0 for a null or empty text, whose rate is 1 and whose single
    copy takes nothing. A null source is a source of its own, the last; a source without words has
    the target 0. Rows with the same source and size are alike: which of them get the extra copy is
    a matter of a hash of the id, and of rows that are equal in that too either may. An empty table
    gives an empty result; columns other than the three named are not read.

    Documents count as cells of (source, size). Cells holding more than 1/(4P) of all rows, at most
    4P of them, are dealt to parts.
    """
    spark = docs.sparkSession
    p = partitions(spark)
    rows = columns_of(docs, id_col, source_col, text_col).select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size"),
    )
    rows = cut(rows)
    total = max(rows.count(), 1)
    cells = cut(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    targets = source_targets(cells.select("source", (F.col("size") * F.col("n")).alias("size")), weights, most)
    docs_in = cells.groupBy("source").agg(F.sum("n").alias("docs"))
    targets = cut(
        targets.join(docs_in.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
            "source", "source_size", "target", F.greatest(F.col("source_size") / F.col("docs"), F.lit(1e-12)).alias("mean")
        )
    )
    lam = _solve(cells, targets, most).withColumnRenamed("source", "s")

    hot = cells.filter(F.col("n") * (4 * p) > total).select(
        F.col("source").alias("s"), F.col("size").alias("z"), F.ceil(F.col("n") * (4 * p) / F.lit(total)).cast("int").alias("parts")
    )
    dealt = cut(
        rows.join(F.broadcast(hot), F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")), "left").select(
            "id", "source", "size", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts"))).cast("int").alias("part")
        )
    )
    parts = dealt.groupBy("source", "size", "part").agg(F.count(F.lit(1)).alias("n"))
    known = targets.join(lam, F.col("source").eqNullSafe(F.col("s")), "left").select(
        F.col("source").alias("s"), "source_size", "target", "mean", "lam"
    )
    parts = parts.join(known, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    parts = parts.withColumn("a", F.col("size") / F.col("mean"))
    # A source at its cap has every document ``most`` times: the multiplier there is infinite.
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("target") >= most * F.col("source_size"), float(most)).otherwise(_rate(F.coalesce("lam", F.lit(0.0)), most))
    parts = parts.withColumn("rate", rate).withColumn("base", F.floor(F.col("rate") + 1e-9)).withColumn(
        "share", F.col("n") * F.greatest(F.col("rate") - F.col("base"), F.lit(0.0))
    )
    order = Window.partitionBy("source").orderBy(F.col("size").desc(), "part").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum(F.col("share").cast("decimal(28,9)")).over(order).cast("double")
    parts = (
        parts.withColumn("upto", upto)
        .withColumn("extra", (F.floor(F.col("upto") + 0.5) - F.floor(F.col("upto") - F.col("share") + 0.5)).cast("long"))
        .withColumn("extra", F.least(F.greatest("extra", F.lit(0)), F.col("n")))
        .select(
            "source", "size", "part", "n", "source_size", "target", "rate", (F.col("base") * F.col("n") + F.col("extra")).cast("long").alias("copies")
        )
    )
    parts = cut(parts)
    parts = _nearer(parts, most)
    ranked = dealt.alias("d").join(
        parts.alias("p"),
        F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.size") == F.col("p.size")) & (F.col("d.part") == F.col("p.part")),
    ).select("d.id", "d.source", "d.size", "d.part", "n", "source_size", "target", "rate", "copies")
    rank = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy(F.xxhash64("id", F.lit(2)), "id")) - 1
    copies = F.floor(F.col("copies") / F.col("n")) + F.when(rank < F.col("copies") % F.col("n"), 1).otherwise(0)
    out = ranked.withColumn("k", copies.cast("long"))
    return out.select(
        F.col("id").alias(id_col),
        F.col("size").cast("long").alias("size"),
        F.col("source_size").cast("long").alias("source_size"),
        F.col("target").cast("double").alias("target"),
        (F.col("k") * F.col("size")).cast("long").alias("taken"),
        F.col("k").alias("copies"),
        F.col("rate").alias("rate"),
    )


def _nearer(parts: DataFrame, most: int) -> DataFrame:
    """Single copies more or less in each source that bring the taken words nearer the target.

    Of each power of two of the size, a source offers its smallest and its largest part that can
    take a copy more, and likewise a copy less: 256 offers at most, whatever the source's size.
    The one that leaves the least gap is taken, up to SINGLES times, each once at most."""
    sums = parts.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("missing"))
    log = F.floor(F.log2(F.col("size"))).cast("int")
    one = F.struct(F.col("size").alias("size"), F.col("part").alias("part"))
    sides = (
        parts.filter("size > 0")
        .withColumn("d", F.explode(F.array(F.lit(1), F.lit(-1))))
        .filter(F.when(F.col("d") > 0, F.col("copies") < most * F.col("n")).otherwise(F.col("copies") > 0))
    )
    ends = sides.groupBy("source", "d", log.alias("log")).agg(F.array_distinct(F.array(F.min(one), F.max(one))).alias("ends"))
    offers = ends.select("source", F.explode("ends").alias("end"), "d").groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct(F.col("end.size").alias("size"), F.col("d").cast("long").alias("d"), F.col("end.part").alias("part")))).alias("offers")
    )
    held = offers.alias("o").join(sums.alias("m"), F.col("o.source").eqNullSafe(F.col("m.source"))).select(
        F.col("o.source").alias("source"), F.col("offers"), F.col("missing").cast("double").alias("missing")
    )
    none = F.lit(None).cast("struct<left:double,offer:struct<size:bigint,d:bigint,part:int>>")

    def best(state: Column) -> Column:
        return F.aggregate(
            state["offers"],
            none,
            lambda so_far, o: F.when(
                F.abs(state["missing"] - o["d"] * o["size"]) < F.coalesce(so_far["left"], F.abs(state["missing"]) - 1e-6),
                F.struct(F.abs(state["missing"] - o["d"] * o["size"]).alias("left"), o.alias("offer")),
            ).otherwise(so_far),
        )

    def turn(state: Column, _: Column) -> Column:
        chosen = best(state)["offer"]
        # A part that has given or got a copy is out of play, so that it is within its limits.
        rest = F.filter(state["offers"], lambda o: (o["size"] != chosen["size"]) | (o["part"] != chosen["part"]))
        return F.when(chosen.isNull(), state).otherwise(
            F.struct(
                (state["missing"] - chosen["d"] * chosen["size"]).cast("double").alias("missing"),
                rest.alias("offers"),
                F.concat(state["taken"], F.array(chosen)).alias("taken"),
            )
        )

    start = F.struct(F.col("missing"), F.col("offers"), F.array().cast("array<struct<size:bigint,d:bigint,part:int>>").alias("taken"))
    chosen = held.select("source", F.explode(F.aggregate(F.sequence(F.lit(1), F.lit(SINGLES)), start, turn, lambda s: s["taken"])).alias("c"))
    change = chosen.select(F.col("source").alias("t"), F.col("c.size").alias("z"), F.col("c.part").alias("q"), F.col("c.d").alias("d"))
    moved = parts.join(
        change, F.col("source").eqNullSafe(F.col("t")) & (F.col("size") == F.col("z")) & (F.col("part") == F.col("q")), "left"
    ).select("source", "size", "part", "n", "source_size", "target", "rate", (F.col("copies") + F.coalesce("d", F.lit(0))).cast("long").alias("copies"))
    return cut(moved)
