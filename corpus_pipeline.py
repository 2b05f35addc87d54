"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again
before the next one; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from endweave.llm.common import WORD, cut, delete, ensure_checkpoint_dir, nearby, text_or_empty
from endweave.llm.exact_dedup import exact_dedup, normalised
from endweave.llm.jaccard_join import jaccard_components
from endweave.llm.langid import UNDETERMINED, identify
from endweave.llm.mixing import mix
from endweave.llm.packing import pack

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told, for want of a text or of a single letter, go; a
    missing language is filled in. If no document names its language, none can be told, and only
    documents without a letter go.

    A null or empty text has no letter and goes; a very long text is told from all of it; repeated rows and
    rows without an id are told each for itself, and stay; an empty table stays empty."""
    told = identify(docs, carry=("text", "lang", "source", "n_chars"))
    named = (F.col("lang_pred") != UNDETERMINED) | F.col("text").rlike(r"\p{L}")
    known = F.when(F.col("lang_pred") != UNDETERMINED, F.col("lang_pred"))
    return told.filter(named).withColumn("lang", F.coalesce("lang", known)).select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays; a null id is larger than any other.

    Null texts equal empty ones, of which one stays; texts of any length are compared whole; of rows with
    the same id and text one stays; an empty table stays empty."""
    told = exact_dedup(docs).groupBy(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha")).agg(F.bool_or("kept").alias("stays"), F.count(F.lit(1)).alias("n"))
    # Most documents are the only one with their id and text, and stay: the others are looked up.
    docs = docs.select(*COLUMNS)
    odd = cut(told.filter("not stays or n > 1"))
    keyed = docs.withColumn("own_sha", F.sha2(normalised().cast("binary"), 256))
    found = keyed.join(nearby(odd), keyed.doc_id.eqNullSafe(odd.id) & (keyed.own_sha == odd.sha), "left")
    kept = found.filter("n is null").select(*COLUMNS)
    if odd.filter("stays").limit(1).count():  # rows with the same id and text: one of them
        rank = F.row_number().over(Window.partitionBy("doc_id", "own_sha").orderBy("text", "lang", "source", "n_chars"))
        kept = kept.union(found.filter("stays").withColumn("rank", rank).filter("rank = 1").select(*COLUMNS))
    return kept


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates, by five-word shingles and a similarity of 0.8, the smallest id stays;
    rows without an id stay.

    Null, empty and blank texts have no shingle and are like nothing, so that they stay; a very long text is
    one set of all its shingles; repeated rows of the id that stays all stay, as ``exact`` left one of each;
    an empty table stays empty."""
    docs = docs.select(*COLUMNS)
    groups = jaccard_components(docs, k=5, percent=80)
    gone = groups.filter("doc_id is not null").groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("component_id")).alias("stays"))
    gone = cut(gone.filter("not stays").select("doc_id"))
    return docs.join(nearby(gone), "doc_id", "left_anti").select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its source's weight asks for; documents without a word once.
    Rows equal in id and number of words are alike: each of them as often as the one that is taken most.

    Null and empty texts have no word; a null source is a source of its own; a very long text counts by all
    its words and is taken whole or not; an empty table stays empty."""
    docs = docs.select(*COLUMNS)
    copies = mix(docs).groupBy(F.col("doc_id").alias("id"), F.col("size").alias("words")).agg(F.max("copies").alias("copies"))
    copies = copies.filter("copies > 0")
    sized = docs.withColumn("own_words", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long"))
    found = sized.join(copies, sized.doc_id.eqNullSafe(copies.id) & (sized.own_words == copies.words))
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in bins of 4096 words. Documents without a word, null or empty texts among them,
    are a piece of no words and have no bin; a very long text is cut into pieces, none is left out; repeated
    rows are packed each, in different bins; an empty table has no pieces."""
    return pack(docs)


STAGES = [
    ("language", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("source_mix", mixture),
    ("pack", packed),
]

#: Language models and near-duplicate links are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again.

    A stage's folder goes once the next one is written; the last, which the result reads, stays.
    Checkpoints go with their DataFrames where spark.cleaner.referenceTracking.cleanCheckpoints is set."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            delete(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
