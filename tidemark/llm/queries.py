"""The registered queries: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read, rest_of


def op5_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixing ``documents`` to target weights by weighted fair queueing."""
    from tidemark.llm.fair_mix import fair_mix
    return fair_mix(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "weight")


def op1_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in ``documents`` by fixed patterns and a skip-chain random field."""
    from tidemark.llm.pii import find_pii
    return find_pii(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of ``documents`` by a weighted pattern grammar fitted on ``labels``."""
    from tidemark.llm.toxicity import THRESHOLD, score_toxicity, train
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, train(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", (rest_of(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_hits")


def op3_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies in ``embeddings``: cosine >= 0.98 under equal labels, and their components."""
    from tidemark.llm.subspace_join import near_vectors
    return near_vectors(read(spark, sf_dir, "embeddings"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in ``documents`` by an exact set-similarity join with templates."""
    from tidemark.llm.license_join import license_scan
    return license_scan(read(spark, sf_dir, "documents")).drop("matches")


def op6_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of at most 2048 tokens."""
    from tidemark.llm.packing import pack
    return pack(read(spark, sf_dir, "documents"), word_tokenizer())


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies in ``documents``: Jaccard >= 0.9 of 3-word shingles, and their components."""
    from tidemark.llm.ngram_join import jaccard_join
    return jaccard_join(read(spark, sf_dir, "documents")).drop("group")


def op8_kd_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 5 by integer inner product for every 50th vector of ``embeddings``."""
    from tidemark.llm.kd_search import top_k
    return top_k(read(spark, sf_dir, "embeddings"))


def op9_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of ``pages`` by composite text density."""
    from tidemark.llm.html_text import extract_text
    return extract_text(read(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def word_tokenizer() -> str:
    """Path of the public tokenizer file that packing uses."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op10_context_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of ``documents`` by a word-count base and online logistic context mixing."""
    from tidemark.llm.context_mix import score_texts
    return score_texts(read(spark, sf_dir, "documents"))


def op11_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of ``documents`` by string kernels and ridge regression."""
    from tidemark.llm.language_id import language_id
    return language_id(read(spark, sf_dir, "documents"))


def op12_qdwh_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First four whitened components of ``embeddings`` by QDWH spectral divide and conquer."""
    from tidemark.llm.whitening import whiten
    return whiten(read(spark, sf_dir, "embeddings"))


def op13_one_bit_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for every 100th vector of ``embeddings`` by one-bit codes; a seventh of the
    rows take the next label."""
    from tidemark.llm.hard_negatives import hard_negatives
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read(spark, sf_dir, "embeddings").withColumn("label", label))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` on ``documents``."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_skip_chain_pii, op2_toxicity, op3_subspace_join, op4_license_scan, op5_fair_mix, op6_best_fit_pack,
                                  op7_ngram_jaccard, op8_kd_top_k, op9_text_density, op10_context_mix, op11_string_kernel,
                                  op12_qdwh_whiten, op13_one_bit_negatives, pipeline)}
