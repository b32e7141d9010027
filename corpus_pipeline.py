"""From raw documents to packed training sequences.

STAGES are applied in order.  Each takes (spark, docs, sf_dir), works on everything that the
stage before it kept, and returns a DataFrame that is written as Parquet and read again as the
next one's docs.  All but the last return the columns of ``documents``.

* toxicity: documents that score as toxic go (empty texts have nothing to reject: they stay).
* near_duplicates: near copies share 80 % of their five-word shingles (Jaccard); of each group the
  document of the smallest doc_id stays; ties go to the smallest text hash; documents without
  words stay.
* personal_data: every span found is replaced by its kind in square brackets.
* mixing: a document stays as often as the mix takes it, up to three times, or not at all;
  documents without words have no words to mix and go.
* packing: the token pieces of all documents, placed in sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read, written
from tidemark.llm.fair_mix import fair_mix
from tidemark.llm.ngram_join import jaccard_join
from tidemark.llm.packing import pack
from tidemark.llm.pii import find_pii
from tidemark.llm.queries import word_tokenizer
from tidemark.llm.toxicity import THRESHOLD, score_toxicity, train

#: Rows that share it have the same doc_id and text.
KEY = "row_key"
#: Words of a shingle and percent of Jaccard that make near copies.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def row_key() -> Column:
    return F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(k), "doc_id", "text")), 16, "0") for k in (1, 2)])


def picked(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """Each row of ``docs`` as often as ``copies`` (KEY, copies) says; rows of one key are one."""
    names = docs.columns
    plain = [f"c{i}" for i in range(len(names))]  # whatever docs' columns are called
    some = docs.select(row_key().alias(KEY), *[F.col(n).alias(c) for n, c in zip(names, plain)])
    some = some.join(copies, KEY).dropDuplicates([KEY])
    many = some.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return many.select(*[F.col(c).alias(n) for n, c in zip(names, plain)])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    grammar = train(docs.select("doc_id", "text"), read(spark, sf_dir, "labels"))
    names = docs.columns
    scored = score_toxicity(docs.toDF(*[f"c{i}" if n != "text" else "text" for i, n in enumerate(names)]), grammar)
    return scored.filter(F.col("score") < THRESHOLD).drop("score", "n_hits").toDF(*names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = jaccard_join(docs.select("doc_id", "text", row_key().alias(KEY)), NEAR_WORDS, NEAR_PERCENT, carry=(KEY,))
    # documents without words are in no group: each is its own
    own = F.coalesce(F.col("group").cast("string"), F.col(KEY))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", KEY)).alias("first")
    kept = groups.groupBy(own.alias("g"), F.col("group").isNull().alias("alone")).agg(first, F.count("*").alias("n"))
    copies = F.when(F.col("alone"), F.col("n")).otherwise(1).cast("bigint")
    return picked(docs, kept.select(F.col(f"first.{KEY}").alias(KEY), copies.alias("copies")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    hidden = find_pii(docs, redact=True)
    text = {"text": F.col("redacted"), "n_chars": F.length("redacted").cast(
        docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return hidden.select(*[text[c].alias(c) if text.get(c) is not None else F.col(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mix = fair_mix(docs.select("doc_id", "source", "text", row_key().alias(KEY)), carry=(KEY,))
    return picked(docs, mix.groupBy(KEY).agg(F.sum("copies").alias("copies")).filter("copies > 0"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, word_tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("personal_data", personal_data),
    ("mixing", mixing), ("packing", packing)]

#: Trained models and a tokenizer have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
