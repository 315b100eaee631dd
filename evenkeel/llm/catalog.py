"""The queries of this subpackage, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm import (
    decontaminate,
    fingerprints,
    language,
    line_dedup,
    mixing,
    ngram_join,
    pii,
    prefix_trie,
    quality,
    substring,
    token_counts,
    warc,
    whitening,
)
from evenkeel.llm.scratch import save
from evenkeel.session import scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose 3-word shingles have a similarity of 0.9 or more."""
    return ngram_join.jaccard_components(
        _table(spark, folder, "documents"), ngram_join.Similarity(words=3, num=90, den=100)
    )


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the benchmark items they contain, exact or edited."""
    return decontaminate.contaminated(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    )


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in each document."""
    return pii.personal_data_by_document(_table(spark, folder, "documents"))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """For each document the one that stays among its equals."""
    return fingerprints.exact_duplicates(_table(spark, folder, "documents"))


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of each document."""
    return language.identify(_table(spark, folder, "documents"))


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without sentences of passages that stood in an earlier place."""
    return substring.deduplicated_spans(_table(spark, folder, "documents")).select(
        "doc_id",
        "n_sentences",
        "n_dropped",
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words a mix of all sources takes from each document."""
    return mixing.mixture(_table(spark, folder, "documents"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without lines that a document with a smaller id holds."""
    return line_dedup.deduplicated_lines(_table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The chance that a document is of good quality."""
    return quality.quality_scores(
        _table(spark, folder, "documents"), _table(spark, folder, "labels")
    )


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written to WARC archives and read back."""
    return warc.archived(_table(spark, folder, "pages"), scratch_path(spark, "archives"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    numbered = save(prefix_trie.turns(_table(spark, folder, "conversations")), "turns")
    return prefix_trie.prefix_trie(prefix_trie.spliced(numbered))


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes and tokens of each document."""
    definition = Path(TOKENIZER).read_text(encoding="utf-8")
    return token_counts.token_counts(_table(spark, folder, "documents"), definition, limit=2048)


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The first eight whitened components of each embedding."""
    return whitening.whitened(_table(spark, folder, "embeddings"), components=8).withColumn(
        "deviation", F.col("deviation").cast("long")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_join,
        op2_decontaminate,
        op3_pii,
        op4_exact_dedup,
        op5_language,
        op6_substring_dedup,
        op7_mixing,
        op8_line_dedup,
        op9_quality,
        op10_warc,
        op11_prefix_trie,
        op12_token_counts,
        op13_whitening,
    )
}
