"""A training corpus from raw documents: filter, deduplicate, decontaminate, mix.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps; ``run``
writes every result as Parquet below the shared scratch folder and reads it back as
the next stage's input. ``doc_id`` tells documents apart. A document without id
passes the filter and the dedup stages as itself and is left out of the mix. Null and
empty texts are equal texts; further columns are carried along; empty tables give an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm.decontaminate import contaminated
from evenkeel.llm.fingerprints import exact_duplicates
from evenkeel.llm.mixing import mixed_documents
from evenkeel.llm.ngram_join import Similarity, jaccard_components
from evenkeel.llm.quality import quality_scores
from evenkeel.llm.scratch import save
from evenkeel.llm.text import WHITESPACE

# A document is rejected if its chance to be of good quality is lower.
LEAST_QUALITY = 0.5
_DIGEST = "__text_sha256"


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(ids.select("doc_id").distinct().hint("shuffle_hash"), "doc_id", "left_anti").select(
        *docs.columns
    )


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = quality_scores(docs, labels, least=LEAST_QUALITY)
    return _without(docs, scores.where("predicted = 0"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts.

    Rows that repeat an id with an equal text leave one; an id with several texts is
    decided text by text.
    """
    told = save(exact_duplicates(docs), "told")
    dropped = told.where("not kept")
    again = told.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    again = again.where("n > 1").select("doc_id")
    if again.isEmpty():
        return _without(docs, dropped)
    bare = F.translate(F.coalesce("text", F.lit("")), WHITESPACE, "")
    each = (
        docs.join(again, "doc_id", "left_semi")
        .withColumn(_DIGEST, F.sha2(bare.cast("binary"), 256))
        .dropDuplicates(["doc_id", _DIGEST])
    )
    gone = dropped.select("doc_id", F.col("text_sha256").alias(_DIGEST)).distinct()
    kept = each.join(gone, ["doc_id", _DIGEST], "left_anti").select(*docs.columns)
    return _without(docs, dropped.select("doc_id").unionByName(again)).unionByName(kept)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each component of similar texts."""
    joined = jaccard_components(docs, Similarity(words=5, num=80, den=100))
    return _without(docs, joined.where("component_id <> doc_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item, neither exact nor edited."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, contaminated(docs, benchmark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources, with a column ``copy`` that numbers repeats."""
    return mixed_documents(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_dedup),
    ("n-gram jaccard join", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix_sources),
]

# Classifier and alignment have no SQL; the tests compare with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
