"""Two site catalogs side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from endweave.operators.design import resolved
from endweave.operators.intervals import FINE, points_in
from endweave.session import cut


def _reach(a: DataFrame, b: DataFrame, tolerance: int) -> DataFrame:
    """(a, b, wish, turn): pairs of sites within the tolerance; a site of a wants the pair of the least wish,
    one of b goes to the least turn."""
    place = F.struct("chrom", "strand").alias("place")  # null contigs and strands are equal to each other
    left = a.select(place, F.col("start").alias("at"), F.col("row").alias("a"), "ordinal", F.col("gene_id").alias("a_gene"))
    right = b.select(place, (F.col("start") - tolerance).alias("low"), (F.col("start") + tolerance + 1).alias("high"), F.col("row").alias("b"), "pas_id", F.col("gene_id").alias("b_gene"))
    same = (F.col("a_gene") != "") & (F.col("a_gene") == F.col("b_gene"))
    far = F.abs(F.col("at") - F.col("low") - tolerance)
    wish = F.struct((~F.coalesce(same, F.lit(False))).alias("other_gene"), far.alias("far"), "pas_id", "low", "b")
    pairs = points_in(left, right, ["place"], "at", "low", "high", width=FINE)
    return pairs.select("a", "b", wish.alias("wish"), F.struct("ordinal", "a").alias("turn"))


def crosswalk(a: DataFrame, b: DataFrame, tolerance: int = 24) -> DataFrame:
    """Greedy one-to-one matches of a's sites, in their order, with b's nearest within the tolerance.

    Columns of both: pas_id, chrom, strand, start, gene_id; a has ``ordinal`` too. Among b's free
    sites in reach those of the same gene come first, then the distance, then the id. Sites without a
    start match none; null contigs and strands are contigs and strands.

    A pair in which both sites come first for each other is what going through a's sites would make of
    them, whatever becomes of others, and so all such pairs are taken at once, round by round, until
    no pair of free sites is left. A round takes at least one pair of every group of sites in reach.
    """
    a, b = cut(a.withColumn("row", F.monotonically_increasing_id())), cut(b.withColumn("row", F.monotonically_increasing_id()))
    pairs, matched = cut(_reach(a, b, tolerance)), None
    while not pairs.isEmpty():
        ranked = pairs.withColumn("wanted", F.min("wish").over(Window.partitionBy("a"))).withColumn("first", F.min("turn").over(Window.partitionBy("b")))
        ranked = cut(ranked.withColumn("taken", (F.col("wish") == F.col("wanted")) & (F.col("turn") == F.col("first"))).drop("wanted", "first"))
        taken = ranked.filter("taken").select("a", "b", F.col("wish.far").alias("distance"))
        matched = taken if matched is None else matched.union(taken)
        left = ranked.filter("not taken").drop("taken").join(taken.select("a"), "a", "left_anti").join(taken.select("b"), "b", "left_anti")
        pairs = cut(left.select("a", "b", "wish", "turn"))
    if matched is None:
        matched = pairs.select("a", "b", F.lit(None).cast("long").alias("distance"))
    gene = lambda c: F.coalesce(c, F.lit("")).alias
    own, other = a.alias("x").join(matched.alias("m"), F.col("x.row") == F.col("m.a"), "left"), b.alias("y")
    both = own.join(other, F.col("y.row") == F.col("m.b"), "left").select(
        F.col("x.pas_id").alias("a_pas_id"),
        F.coalesce("y.pas_id", F.lit("")).alias("b_pas_id"),
        F.col("x.chrom").alias("chrom"),
        F.col("x.strand").alias("strand"),
        F.col("m.distance").cast("long").alias("distance"),
        gene(F.col("x.gene_id"))("a_gene_id"),
        gene(F.col("y.gene_id"))("b_gene_id"),
        F.when(F.col("m.b").isNull(), "a_only").otherwise("matched").alias("match_class"),
    )
    free = other.join(matched.alias("m"), F.col("y.row") == F.col("m.b"), "left_anti")
    empty, none = F.lit(""), F.lit(None).cast("long")
    return both.union(
        free.select(empty.alias("a_pas_id"), "pas_id", "chrom", "strand", none.alias("distance"), empty.alias("a_gene_id"), gene(F.col("gene_id"))("b_gene_id"), F.lit("b_only").alias("match_class"))
    )


def concordance(matches: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """Effects of matched sites in shared contrasts (contrast_id, pas_id, delta), and whether they agree."""
    left = a.filter("delta is not null").select("contrast_id", F.col("pas_id").alias("a_pas_id"), F.col("delta").alias("a_delta"))
    right = b.filter("delta is not null").select("contrast_id", F.col("pas_id").alias("b_pas_id"), F.col("delta").alias("b_delta"))
    zero = (F.col("a_delta") == 0) | (F.col("b_delta") == 0)
    agree = F.when(zero, "zero_effect").when((F.col("a_delta") > 0) == (F.col("b_delta") > 0), "true").otherwise("false")
    rows = matches.filter("match_class = 'matched'").join(left, "a_pas_id").join(right, ["contrast_id", "b_pas_id"])
    return rows.select("contrast_id", "a_pas_id", "b_pas_id", "a_delta", "b_delta", agree.alias("direction_agreement"), "distance")


def premature_agreement(matches: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """For matched sites and each contrast in which either is a candidate (contrast_id, pas_id): which is."""
    m = matches.filter("match_class = 'matched'").select("a_pas_id", "b_pas_id")
    left = m.join(a.select("contrast_id", F.col("pas_id").alias("a_pas_id")).distinct(), "a_pas_id").withColumn("in_a", F.lit(True))
    right = m.join(b.select("contrast_id", F.col("pas_id").alias("b_pas_id")).distinct(), "b_pas_id").withColumn("in_b", F.lit(True))
    both = left.join(right, ["contrast_id", "a_pas_id", "b_pas_id"], "full")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    return both.select("contrast_id", "a_pas_id", "b_pas_id", flag("in_a").alias("a_candidate"), flag("in_b").alias("b_candidate"), (flag("in_a") & flag("in_b")).alias("agreement"))


def contrast_pairs(samples: DataFrame, least: int = 2) -> DataFrame:
    """All pairs of conditions in their order: contrast_id, numerator, denominator, sizes and status."""
    per = samples.groupBy("condition").agg(F.min("ordinal").alias("o"), F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    d = per.select(F.col("condition").alias("denominator"), F.col("o").alias("od"), F.col("n").alias("n_den"))
    n = per.select(F.col("condition").alias("numerator"), F.col("o").alias("on"), F.col("n").alias("n_num"))
    low = F.least("n_num", "n_den") < 3
    return d.join(n, F.col("od") < F.col("on")).select(
        F.concat_ws("_vs_", "numerator", "denominator").alias("contrast_id"), "numerator", "denominator", "n_num", "n_den",
        F.when(low, F.concat(F.lit("LOW_REPLICATION_N"), F.least("n_num", "n_den").cast("string"))).otherwise("OK").alias("design_status"),
    )


def pairing_states(samples: DataFrame, contrasts: DataFrame) -> DataFrame:
    """(contrast_id, pairing_status, n_pairs): whether both conditions have the same subjects, equally often."""
    per = samples.groupBy("condition", "subject").agg(F.count(F.lit(1)).alias("n"))
    sides = [
        contrasts.join(per, contrasts[c] == per["condition"]).select("contrast_id", F.coalesce("subject", F.lit("")).alias("subject"), F.col("n").alias(c[0]))
        for c in ("numerator", "denominator")
    ]
    both = sides[0].join(sides[1], ["contrast_id", "subject"], "full")
    g = both.groupBy("contrast_id").agg(
        F.bool_or(F.col("subject") == "").alias("missing"),
        F.count_if(F.col("n").isNotNull() & F.col("d").isNotNull()).alias("shared"),
        F.bool_and(F.coalesce(F.col("n") == F.col("d"), F.lit(False))).alias("equal"),
    )
    status = F.when(F.col("missing"), "no_subjects").when(F.col("equal"), "complete").when(F.col("shared") == 0, "disjoint").otherwise("incomplete")
    return g.select("contrast_id", status.alias("pairing_status"), F.when(status == "complete", F.col("shared")).otherwise(0).cast("long").alias("n_pairs"))


def class_counts(matches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(match_class, sites) of a crosswalk, and of each group of ``by``."""
    return matches.groupBy(*(by or []), "match_class").agg(F.count(F.lit(1)).alias("sites"))


def over_contrasts(fit, counts: DataFrame, samples: DataFrame, mode: str = "auto", least: int = 2) -> DataFrame:
    """The results of ``fit(counts, samples, denominator, numerator, design=...)`` for every pair of
    conditions, each by its own resolved design: contrast_id, design, and the fit's columns.

    Contrasts are as many as pairs of conditions, and are named by the driver; genes stay in Spark."""
    pairs = contrast_pairs(samples, least)
    pairing = {r["contrast_id"]: r for r in pairing_states(samples, pairs).collect()}
    out = None
    for row in sorted(pairs.collect(), key=lambda r: r["contrast_id"]):
        state = pairing[row["contrast_id"]]
        design, _ = resolved(mode, state["pairing_status"], state["n_pairs"])
        one = fit(counts, samples, row["denominator"], row["numerator"], design=design)
        one = one.select(F.lit(row["contrast_id"]).alias("contrast_id"), F.lit(design).alias("design"), *one.columns)
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError(f"no two conditions have {least} samples")
    return out
