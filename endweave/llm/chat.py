"""Chat formatting in budgeted windows.

Prefix sums of turn tokens cut a conversation into turn-aligned spans, in which an answer stands
with its prompt wherever a window can hold both. Each window holds the system turn, as much of the
last turns of the window before as fits, and the turns of its span; only assistant texts of the
span are targets, so that repeated ones are masked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from endweave.llm.common import WORD, columns_of

START, END = "<|im_start|>", "<|im_end|>\n"
#: Tokens that the template adds to a turn.
OVERHEAD = 4


def escaped(text: Column, line: bool = False) -> Column:
    r"""Doubles backslashes and breaks every ``<|``, so that no control string is left; with ``line``
    line ends go too. ``unescaped`` is the inverse: a single backslash stands only behind ``<``."""
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))
    return F.replace(out, F.lit("\n"), F.lit("<\\,")) if line else out


def unescaped(text: Column, line: bool = False) -> Column:
    out = F.replace(text, F.lit("<\\,"), F.lit("\n")) if line else text
    return F.replace(F.replace(out, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def format_windows(turns: DataFrame, budget: int = 1024, history: int = 2) -> DataFrame:
    """Windows (conv_id, window, formatted, loss_spans, n_turns, n_repeated, tokens) of the rows
    (conv_id, turn, role, text).

    Tokens are white-space separated words, and OVERHEAD for the template of each turn. An exchange
    is a prompt (turns of any role but ``assistant``) with the assistant turns that answer it; one
    that a window can't hold beside the system turn (a first turn of the role ``system``) counts
    turn by turn. Of what the system turn leaves of the budget, two fifths are the stride of the
    spans: an exchange belongs to the span in which it starts, so that a span is shorter than two
    strides, and one longer than a stride has a span of its own. Only a turn that is too long by
    itself exceeds the budget, alone; no text is cut. Of the ``history`` last turns of the span
    before as many are repeated, the last first, as still fit. loss_spans are (start, end) code
    points of ``formatted``; n_repeated turns come first.

    A null text or role counts as empty, a null conv_id is a conversation. Turns go by turn number
    (null first), then role and text; repeated rows are turns of their own. An empty table gives an
    empty result; other columns are not read.
    """
    rows = columns_of(turns, "conv_id", "turn", "role", "text").select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("tokens", (F.regexp_count("text", F.lit(WORD)) + OVERHEAD).cast("long"))
    conv = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    whole = conv.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto, before = conv.rowsBetween(Window.unboundedPreceding, 0), conv.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("pos", F.row_number().over(conv))
    rows = rows.withColumn("system", (F.col("pos") == 1) & (F.col("role") == "system"))
    rows = rows.withColumn("own", F.when(F.col("system"), 0).otherwise(F.col("tokens")))
    used = F.coalesce(F.max(F.when(F.col("system"), F.col("tokens"))).over(whole), F.lit(0))
    rows = rows.withColumn("used", used)
    rows = rows.withColumn("stride", F.greatest(F.lit(budget // 10), F.floor((F.lit(budget) - F.col("used")) * 2 / 5)).cast("long"))
    rows = rows.withColumn("start", F.coalesce(F.sum("own").over(before), F.lit(0)))
    others = F.lag("system").over(conv)
    begins = ~F.col("system") & (others.isNull() | others | ((F.col("role") != "assistant") & (F.lag("role").over(conv) == "assistant")))
    rows = rows.withColumn("begins", begins).withColumn("exchange", F.sum(F.col("begins").cast("int")).over(upto))
    exchange = Window.partitionBy("conv_id", "exchange")
    rows = rows.withColumn("together", F.sum("own").over(exchange)).withColumn("apart", F.col("together") + F.col("used") > budget)
    rows = rows.withColumn("from", F.when(F.col("apart"), F.col("start")).otherwise(F.min("start").over(exchange)))
    rows = rows.withColumn("block", F.when(~F.col("system"), F.floor(F.col("from") / F.col("stride"))))
    rows = rows.withColumn("long", F.when(~F.col("system"), F.when(F.col("apart"), F.col("own")).otherwise(F.col("together")) > F.col("stride")))
    moved = (F.lag("block").over(conv) != F.col("block")) | F.lag("long").over(conv) | (F.lag("long").over(conv).isNotNull() & F.col("long"))
    rows = rows.withColumn("moved", ((F.col("begins") | F.col("apart")) & F.coalesce(moved, F.lit(False))).cast("int"))
    rows = rows.withColumn("window", F.sum("moved").over(upto).cast("int"))
    rows = rows.withColumn("last", F.max("window").over(whole))
    by_window = Window.partitionBy("conv_id").orderBy("window")
    rows = rows.withColumn("next", F.sum("own").over(by_window.rangeBetween(1, 1)))
    end = Window.partitionBy("conv_id", "window").orderBy(F.col("pos").desc())
    rows = rows.withColumn("from_end", F.row_number().over(end)).withColumn("end_tokens", F.sum("own").over(end.rowsBetween(Window.unboundedPreceding, 0)))
    again = ~F.col("system") & (F.col("from_end") <= history) & (F.col("end_tokens") + F.col("next") + F.col("used") <= budget)
    again = F.coalesce(again, F.lit(False))
    windows = (
        F.when(F.col("system"), F.sequence(F.lit(0), F.col("last")))
        .when(again, F.array(F.col("window"), F.col("window") + 1))
        .otherwise(F.array(F.col("window")))
    )
    placed = rows.withColumn("home", F.col("window")).withColumn("window", F.explode(windows))
    head = F.concat(F.lit(START), escaped(F.col("role"), line=True), F.lit("\n"))
    body = escaped(F.col("text"))
    placed = placed.select(
        "conv_id",
        "window",
        F.struct(
            "pos",
            F.concat(head, body, F.lit(END)).alias("piece"),
            F.length(head).alias("head"),
            F.length(body).alias("body"),
            (F.col("window") != F.col("home")).alias("repeated"),
            (F.col("role") == "assistant").alias("target"),
            "tokens",
        ).alias("t"),
    )
    # A window's turns are bounded by the budget, or are one turn.
    grouped = placed.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    spans = F.aggregate(
        "ts",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda held, t: F.struct(
            (held["at"] + F.length(t["piece"])).cast("long").alias("at"),
            F.when(
                t["target"] & ~t["repeated"],
                F.concat(
                    held["spans"],
                    F.array(F.struct((held["at"] + t["head"]).cast("long").alias("start"), (held["at"] + t["head"] + t["body"]).cast("long").alias("end"))),
                ),
            )
            .otherwise(held["spans"])
            .alias("spans"),
        ),
        lambda held: held["spans"],
    )
    return grouped.select(
        "conv_id",
        "window",
        F.array_join(F.transform("ts", lambda t: t["piece"]), "").alias("formatted"),
        spans.alias("loss_spans"),
        F.size("ts").alias("n_turns"),
        F.size(F.filter("ts", lambda t: t["repeated"])).alias("n_repeated"),
        F.aggregate("ts", F.lit(0).cast("long"), lambda held, t: held + t["tokens"]).alias("tokens"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns, loss, formatted_chars) of each conversation, from the formatted
    windows alone: repeated turns are left out, control strings unescaped."""
    parts = F.split("formatted", r"<\|im_end\|>\n", -1)
    fresh = F.slice(parts, F.col("n_repeated") + 1, F.size(parts) - 1 - F.col("n_repeated"))

    def turn(part: Column) -> Column:
        rest = F.substring(part, F.lit(len(START) + 1), F.length(part))
        role = F.substring_index(rest, "\n", 1)
        text = F.substring(rest, F.length(role) + 2, F.length(rest))
        return F.concat(unescaped(role, line=True), F.lit("\n"), unescaped(text), F.lit("\n"))

    def target(span: Column) -> Column:
        return unescaped(F.substring(F.col("formatted"), (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int")))

    each = windows.select(
        "conv_id",
        F.struct(
            "window",
            F.array_join(F.transform(fresh, turn), "").alias("turns"),
            F.array_join(F.transform("loss_spans", target), "").alias("loss"),
        ).alias("w"),
        F.size(fresh).cast("long").alias("n"),
        F.length("formatted").cast("long").alias("chars"),
    )
    # A digest of a conversation needs all of its text, so that its windows meet here.
    joined = each.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sort_array(F.collect_list("w")).alias("ws"), F.sum("chars").alias("formatted_chars")
    )
    return joined.select(
        "conv_id",
        "n_turns",
        F.array_join(F.transform("ws", lambda w: w["turns"]), "").alias("turns"),
        F.array_join(F.transform("ws", lambda w: w["loss"]), "").alias("loss"),
        "formatted_chars",
    )


def conversation_digests(turns: DataFrame, budget: int = 1024, history: int = 2) -> DataFrame:
    """One row per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    back = read_back(format_windows(turns, budget, history))
    return back.select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
