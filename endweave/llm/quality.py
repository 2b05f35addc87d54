"""Quality rules with risk-controlled thresholds.

Documents are measured once. Of the labelled ones five in sixteen, drawn by a hash, shape cutoffs: for each
stratum, rule and budget of false rejections the cutoff that catches most bad documents, a nested
series from strict budgets to loose ones. The others, held out, decide: a series is followed
as long as the exact binomial test rejects "more than RISK of the good documents fall to any rule", at
a level that is shared among all strata (Bonferroni) and handed on inside a series (fixed sequence).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from endweave.llm.common import SPACE, columns_of, cut, nearby, text_or_empty

#: The white space of SPACE, and what counts as a symbol.
BLANKS, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words of a window of repeats; the base rules' fewest words and percent of repeated words.
WINDOW, FEWEST, REPEATED = 5, 10, 20
#: The share of a stratum's good documents that may be rejected, and the chance that any stratum's bound
#: does not hold; budgets of the series; how much likelier a bad document must be to fall to a cutoff.
RISK, CHANCE, BUDGETS, LIFT = 0.05, 0.05, (0.0, 0.002, 0.005), 5
#: Labelled documents shape cutoffs whose md5(id) begins with a hex digit below this one: five in sixteen.
SHAPING = "5"
#: Rules: (value in thousandths of a word, character or line; cutoffs from loose to tight). A document
#: whose value is above the cutoff falls to the rule.
RULES: dict[str, tuple[str, tuple[int, ...]]] = {
    "symbols": ("n_symbols * 1000 div n_words", (1000, 700, 500, 350, 250, 200, 150, 100, 70, 50)),
    "exclamations": ("n_exclamations * 1000 div n_words", (1000, 700, 500, 350, 250, 200)),
    "capitals": ("n_capitals * 1000 div word_chars", (800, 600, 500, 400, 300, 250, 200)),
    "long_words": ("word_chars * 1000 div n_words", (20000, 15000, 12000, 10000, 9000, 8000, 7500)),
    "short_words": ("- word_chars * 1000 div n_words", (-1500, -2000, -2500, -3000)),
    "dup_lines": ("n_dup_lines * 1000 div n_lines", (800, 600, 500, 400, 300, 200)),
    "repeats": ("n_repeat_words * 1000 div n_words", (180, 150, 120, 100, 80)),
}


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once: functions over arrays would do so for each element."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _covered(windows: Column) -> Column:
    """Words in windows (hashes, in order) that are found twice or more: of each such window, from left to
    right, the words that the one before does not cover."""

    def places(found: Column) -> Column:
        at = lambda j: F.get(found, j)["hash"]
        twice = lambda j: F.coalesce(at(j) == at(j - 1), F.lit(False)) | F.coalesce(at(j) == at(j + 1), F.lit(False))
        again = F.filter(F.sequence(F.lit(0), F.size(found) - 1), twice)
        return F.sort_array(F.transform(again, lambda j: F.get(found, j)["at"]))

    def words(starts: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(-WINDOW).alias("last"))
        step = lambda held, at: F.struct((held["words"] + F.least(F.lit(WINDOW), at - held["last"])).cast("long").alias("words"), at.alias("last"))
        return F.aggregate(starts, start, step, lambda held: held["words"])

    ordered = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("hash"), i.alias("at"))))
    return bound(ordered, lambda found: words(places(found)))


def repeated_words(words: Column) -> Column:
    """The number of words in windows of WINDOW words that occur twice or more, the first one included.

    Windows are compared by 64-bit hashes, inside one text."""

    def by_hash(hashes: Column) -> Column:
        window = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])
        windows = F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW), window)
        told = lambda v: F.when(F.size(F.array_distinct(v)) == F.size(v), F.lit(0).cast("long")).otherwise(_covered(v))
        return F.when(F.size(hashes) > WINDOW, bound(windows, told)).otherwise(F.lit(0).cast("long"))

    return bound(F.transform(words, lambda w: F.xxhash64(w)), by_hash)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """(id, stratum, n_words, word_chars, n_symbols, n_exclamations, n_capitals, n_lines, n_dup_lines,
    n_repeat_words, base_failed), a row for each document."""
    text = text_or_empty(text_col)
    without = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    trimmed = F.btrim(text, F.lit(BLANKS))
    words = F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(BLANKS))) > 0)
    counted = columns_of(docs, id_col, text_col, stratum_col).select(
        F.col(id_col).alias("id"),
        F.col(stratum_col).alias("stratum"),
        bound(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"))).alias("w"),
        bound(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("l"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        without(SYMBOLS).cast("long").alias("n_symbols"),
        without("!?").cast("long").alias("n_exclamations"),
        without(CAPITALS).cast("long").alias("n_capitals"),
    )
    failed = (F.col("n_words") < FEWEST) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    plain = counted.select("*", "w.*", F.col("l.n").alias("n_lines"), F.col("l.dup").alias("n_dup_lines")).drop("w", "l")
    return plain.withColumn("base_failed", failed)


def log_gamma(x: Column) -> Column:
    """For x of 1 or more, by the asymptotic series at x + 8."""
    y = x + 8
    steps = F.log(x)
    for k in range(1, 8):
        steps = steps + F.log(x + k)
    z = F.lit(1.0) / (y * y)
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + (F.lit(1 / 12) - z * (F.lit(1 / 360) - z * (F.lit(1 / 1260) - z / 1680))) / y - steps


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of n trials where k < n * p, else 1: terms from k downwards, as far as doubles tell them
    from nothing (twelve standard deviations)."""
    k, n = k.cast("double"), n.cast("double")
    first = F.exp(log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log1p(F.lit(-p)))
    terms = F.least(k, 12 * F.sqrt(n * p * (1 - p)) + 50).cast("int")
    start = F.struct(first.alias("term"), first.alias("sum"))

    def step(held: Column, i: Column) -> Column:
        term = held["term"] * (k - i + 1) / (n - k + i) * ((1 - p) / p)
        return F.struct(term.alias("term"), (held["sum"] + term).alias("sum"))

    steps = F.when(terms > 0, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>"))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.aggregate(steps, start, step, lambda held: held["sum"]))


def _value(rule: str) -> Column:
    return F.expr(RULES[rule][0])


def _series(shaping: DataFrame) -> DataFrame:
    """(stratum, budget, a cutoff for each rule, null where it takes no part) from labelled documents."""
    struct = lambda rule, cuts: F.struct(F.lit(rule).alias("rule"), F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: _value(rule) <= c)).alias("step"))
    falls = F.array(*[struct(rule, cuts) for rule, (_, cuts) in RULES.items()])
    tally = shaping.select("stratum", "good", F.explode(falls).alias("f")).groupBy("stratum", "good", "f.rule", "f.step").agg(F.count(F.lit(1)).alias("n"))
    last = F.element_at(F.create_map(*[F.lit(x) for r, (_, cuts) in RULES.items() for x in (r, len(cuts) - 1)]), F.col("rule"))
    # What a cutoff rejects is rejected by all tighter ones; the last step stands for no cutoff.
    tally = tally.select("stratum", "good", "rule", "n", F.explode(F.sequence(F.col("step"), last + 1)).alias("step"))
    good, bad = F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)), F.sum(F.when(~F.col("good"), F.col("n")).otherwise(0))
    sums = tally.groupBy("stratum", "rule", "step").agg(good.alias("g"), bad.alias("b"), F.first(last).alias("last"))
    whole = Window.partitionBy("stratum", "rule")
    sums = sums.withColumns({"all_g": F.max("g").over(whole), "all_b": F.max("b").over(whole)}).filter("step <= last")
    lifted = F.col("b") * F.col("all_g") > LIFT * F.col("g") * F.col("all_b")
    budgets = F.explode(F.array(*[F.lit(b) for b in BUDGETS]))
    told = sums.filter((F.col("b") > 0) & lifted).select("*", budgets.alias("budget")).filter(F.col("g") <= F.col("budget") * F.col("all_g") / len(RULES))
    best = told.groupBy("stratum", "budget", "rule").agg(F.max_by("step", F.struct("b", -F.col("step"))).alias("step"))
    cutoff = lambda rule: F.get(F.array(*map(F.lit, RULES[rule][1])), F.col("step"))
    return best.groupBy("stratum", "budget").agg(*[F.max(F.when(F.col("rule") == rule, cutoff(rule))).alias(f"cut_{rule}") for rule in RULES])


def _fallen() -> Column:
    """The rules that a document falls to."""
    named = [F.when(_value(rule) > F.col(f"cut_{rule}"), F.lit(rule)) for rule in sorted(RULES)]
    return F.array_compact(F.array(*named))


def certified(labelled: DataFrame) -> DataFrame:
    """(stratum, a cutoff for each rule) of the strata whose bound on false rejections is proven, from
    measured documents with ``good`` that have passed the base rules."""
    shaping = F.md5(F.col("id").cast("string").cast("binary")) < SHAPING
    series = cut(_series(labelled.filter(shaping)))
    held = labelled.filter(~shaping & F.col("good"))
    tried = held.join(nearby(series.withColumnRenamed("stratum", "of")), F.col("stratum").eqNullSafe(F.col("of")))
    counts = tried.groupBy("stratum", "budget").agg(F.count_if(F.size(_fallen()) > 0).alias("k"), F.count(F.lit(1)).alias("n"))
    tests = cut(counts)  # a row for each stratum and budget
    m = max(tests.select("stratum").distinct().count(), 1)
    tests = tests.withColumn("p", binomial_tail(F.col("k"), F.col("n"), RISK))
    follows = F.max("p").over(Window.partitionBy("stratum").orderBy("budget").rowsBetween(Window.unboundedPreceding, 0))
    passed = tests.withColumn("worst", follows).filter(F.col("worst") <= CHANCE / m)
    passed = passed.groupBy(F.col("stratum").alias("of")).agg(F.max("budget").alias("upto"))
    return series.join(F.broadcast(passed), F.col("stratum").eqNullSafe(F.col("of")) & (F.col("budget") == F.col("upto"))).drop("of", "upto", "budget")


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """One row per document: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, failed_rules (names, sorted and comma-joined).

    Labels are (id, quality): 1 for a good document, 0 for a bad one, others play no part; of several
    labels of an id the best counts. A document falls if it fails the base rules, or a rule at the cutoff
    of its stratum. A stratum without a proven bound, for want of labels (about 95 held-out good documents
    that all stay), rejects by the base rules alone; a null stratum is a stratum. A null text counts as
    empty and fails; null ids have no label; repeated rows are judged alike, each for itself; an empty
    table gives an empty result, and without labels only the base rules count. Other columns are not read.
    """
    rows = cut(measured(docs, id_col, text_col, stratum_col))
    rated = columns_of(labels, id_col, "quality").filter("quality in (0, 1)")
    rated = rated.groupBy(F.col(id_col).alias("rated")).agg((F.max("quality") == 1).alias("good"))
    labelled = rows.filter("not base_failed").join(rated, F.col("id") == F.col("rated")).drop("rated")
    cuts = cut(certified(cut(labelled)).withColumnRenamed("stratum", "of"))
    judged = rows.join(nearby(cuts), F.col("stratum").eqNullSafe(F.col("of")), "left")
    fallen = F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(_fallen())
    return judged.withColumn("fallen", fallen).select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.size("fallen") == 0)).alias("kept"),
        F.array_join("fallen", ",").alias("failed_rules"),
    )
