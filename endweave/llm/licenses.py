"""License scans with a positional index of rare words.

Templates are whole licenses, notices, passages and identifiers, by default those of ``license_texts``;
all their words are indexed with their positions. Of each file the licence words with the highest inverse
document frequency in the scanned corpus are looked up. Each votes for the places at which templates that
hold it would have to start, a pair (template, offset), so that postings meet at the same relative
position. A pair is verified where it got a vote: its key phrase must stand there word for word, and
then COVER of the template's weight.

No place is missed. Only a template's rarest words take votes, those beyond which less than COVER of its
weight is left: where COVER matches, one of them does. What is not looked up of a file are licence words
no rarer than some IDF; a template of which such words could make up COVER is open for that file, which
then looks up the rarest word of its key phrase, wherever that ranks.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from endweave.llm.common import columns_of, cut
from endweave.llm.license_texts import TEMPLATES

#: Words are runs of digits, letters a-z and anything beyond ASCII; this is what lies between.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Label and phrase of the base scan.
BASE = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)

#: Words of a file that are looked up for all templates, and the part of a template's weight that must match.
RARE, COVER = 16, 0.6


def words_of(text: Column) -> Column:
    """Words in order. Only A-Z are to be folded: of other letters ``lower`` turns just two into
    ASCII ones, the Kelvin sign and the dotted capital I, which are put out of its way."""
    safe = F.replace(F.replace(text, F.lit("K"), F.lit("ĸ")), F.lit("İ"), F.lit("ı"))
    return F.array_remove(F.split(F.lower(safe), BETWEEN, -1), "")


class Index:
    """Templates (label, key phrase, passage) as words with positions; base phrases are templates whose
    key phrase is all of them."""

    def __init__(self, templates: tuple[tuple[str, str, str], ...]):
        self.labels: list[tuple[str, bool]] = []
        self.words: list[list[str]] = []
        self.keys: list[range] = []
        for (label, key, passage), base in [*(((label, p, p), True) for label, p in BASE), *((t, False) for t in templates)]:
            words, key_words = (re.sub(BETWEEN, " ", x.lower()).split() for x in (passage, key))
            at = next((i for i in range(len(words)) if words[i : i + len(key_words)] == key_words), None)
            if at is None or not key_words:
                raise ValueError(f"the key phrase {key!r} does not stand in its passage {passage!r}")
            self.labels.append((label, base))
            self.words.append(words)
            self.keys.append(range(at, at + len(key_words)))

    def vocabulary(self) -> list[str]:
        return sorted({w for words in self.words for w in words})

    def anchors(self, weight: dict[str, float]) -> list[str]:
        """The rarest word of each template's key phrase."""
        return [min((words[i] for i in key), key=lambda w: (-weight[w], w)) for words, key in zip(self.words, self.keys, strict=True)]

    def signatures(self, weight: dict[str, float]) -> list[tuple[set[int], float]]:
        """Of each template (positions of its rarest words, of which one must match where COVER of the weight
        does; the IDF from which on words no rarer make up COVER)."""
        out = []
        for words in self.words:
            total = sum(weight[w] for w in words)
            rest, chosen = total, set()
            for i in sorted(range(len(words)), key=lambda i: (-weight[words[i]], i)):
                if rest < COVER * total - 1e-9 * total:
                    break
                chosen.add(i)
                rest -= weight[words[i]]
            common, opens = 0.0, 0.0
            for w in sorted(words, key=lambda w: weight[w]):
                common, opens = common + weight[w], weight[w]
                if common >= COVER * total - 1e-9 * total:
                    break
            out.append((chosen, opens))
        return out


def weights(rows: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency of each word of the templates over all rows (words)."""
    known = rows.sparkSession.createDataFrame([(w,) for w in [*vocabulary, ""]], "word string")
    each = rows.select(F.explode(F.array_append(F.array_distinct("words"), F.lit(""))).alias("word"))  # "" for the total
    counts = dict(each.join(F.broadcast(known), "word").groupBy("word").count().collect())  # the vocabulary at most
    total = counts.get("", 0)
    return {w: round(math.log((total + 1) / (counts.get(w, 0) + 1)) + 1.0, 9) for w in vocabulary}


def _voted(hits: DataFrame, posted: DataFrame, rare: int) -> DataFrame:
    """(i, g, c, at): pairs of template and offset that a looked-up word of file (i, g) votes for."""
    file = Window.partitionBy("id", "h")
    rank = F.dense_rank().over(file.orderBy(F.col("idf").desc(), "word"))
    ranked = hits.withColumn("rank", rank)
    # The rarest of the words that are not looked up, null where all are.
    left = F.max(F.when(F.col("rank") > rare, F.col("idf"))).over(file)
    votes = ranked.withColumn("left", left).join(posted, F.col("word") == F.col("posted"))
    is_open = F.coalesce(F.col("left") >= F.col("opens"), F.lit(False))
    votes = votes.filter(F.when(is_open, F.col("anchor")).otherwise(F.col("signed") & (F.col("rank") <= rare))).select("id", "h", "t", (F.col("pos") - F.col("rel")).alias("at")).filter("at >= 0")
    return votes.distinct().select(F.col("id").alias("i"), F.col("h").alias("g"), F.col("t").alias("c"), "at")


def _matched(pairs: DataFrame, posted: DataFrame, hits: DataFrame) -> DataFrame:
    """(i, g, t, at, w) for each posting that stands in the file where the pair wants it."""
    expected = pairs.join(posted, F.col("c") == F.col("t")).select("i", "g", "t", "at", (F.col("at") + F.col("rel")).alias("there"), "posted", "w")
    there = F.col("i").eqNullSafe(F.col("id")) & (F.col("g") == F.col("h")) & (F.col("there") == F.col("pos")) & (F.col("posted") == F.col("word"))
    return expected.join(hits, there).select("i", "g", "t", "at", "w")


def _places(files: DataFrame, index: Index, weight: dict[str, float], rare: int) -> DataFrame:
    """(i, g, t, at, cover) of the templates found in files (id, h, words), each of which occurs once."""
    spark = files.sparkSession
    known = [(w, weight[w]) for w in index.vocabulary()]
    signs, anchors = index.signatures(weight), index.anchors(weight)
    postings = [
        (t, i, w, weight[w], i in index.keys[t], i in signs[t][0], signs[t][1], i in index.keys[t] and w == anchors[t])
        for t, words in enumerate(index.words)
        for i, w in enumerate(words)
    ]
    totals = [(t, round(sum(weight[w] for w in words), 9), len(index.keys[t]), *index.labels[t]) for t, words in enumerate(index.words)]
    # Three tables as large as the templates, whatever the corpus.
    vocabulary = F.broadcast(spark.createDataFrame(known, "word string, idf double"))
    posted = F.broadcast(spark.createDataFrame(postings, "t int, rel int, posted string, w double, in_key boolean, signed boolean, opens double, anchor boolean"))
    total = F.broadcast(spark.createDataFrame(totals, "t int, total double, key_n int, label string, base boolean"))
    hits = files.select("id", "h", F.posexplode("words").alias("pos", "word")).join(vocabulary, "word")
    # Key phrases first: they are short, and few pairs have theirs.
    keyed = _matched(_voted(hits, posted, rare), posted.filter("in_key"), hits).groupBy("i", "g", "t", "at").agg(F.count(F.lit(1)).alias("n"))
    keyed = keyed.join(total.select(F.col("t"), "key_n"), "t").filter("n = key_n").select("i", "g", F.col("t").alias("c"), "at")
    found = _matched(keyed, posted, hits).groupBy("i", "g", "t", "at").agg(F.sum(F.col("w").cast("decimal(18,9)")).cast("double").alias("weight"))
    return (
        found.join(total, "t")
        .withColumn("cover", F.least(F.col("weight") / F.col("total"), F.lit(1.0)))
        .filter(F.col("base") | (F.col("cover") >= COVER))
    )


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple[tuple[str, str, str], ...] = TEMPLATES, rare: int = RARE) -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts all places of the base phrases, first_word and last_word are the smallest and
    largest word index at which one starts, null without one. A template (label, key phrase,
    passage) is found where its key phrase is complete and COVER of its weight matches; score is the
    largest part of a template's weight that matches, 1 for a base phrase, 0 for none. Labels are
    distinct, sorted and joined by commas, the empty string for none. A null text counts as empty; a
    null id is kept. ``rare`` words of a file are looked up for all templates: it changes how many places are
    verified, not the result. Repeated rows have a row each. An empty table gives an empty result; other
    columns are not read. Rows of one id are told apart by a 64-bit hash of their text.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = columns_of(docs, id_col, text_col).select(F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), words_of(text).alias("words"))
    index = Index(templates)
    weight = weights(rows, index.vocabulary())
    # Files without a word of a key phrase hold no template: of these only the number of words stays.
    anchors = F.array(*[F.lit(w) for w in sorted(set(index.anchors(weight)))])
    rows = cut(rows.select("id", "h", F.size("words").cast("long").alias("n_words"), F.when(F.arrays_overlap("words", anchors), F.col("words")).alias("words")))
    files = rows.filter("words is not null").groupBy("id", "h").agg(F.first("words").alias("words"))
    base = F.col("base")
    found = _places(files, index, weight, rare).groupBy(F.col("i"), F.col("g")).agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("at"))).alias("first_word"),
        F.max(F.when(base, F.col("at"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max(F.when(base, F.lit(1.0)).otherwise(F.col("cover"))).alias("score"),
    )
    joined = rows.join(found, F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("g")), "left")
    return joined.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
