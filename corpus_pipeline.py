"""Training-corpus pipeline over ``documents``: score, dedup, decontaminate, tokenise.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. Stages are written as Parquet and read
again before the next one starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm.common import materialise, table
from meterflow.llm.decontaminate import clean_documents
from meterflow.llm.exact_dedup import keep_one
from meterflow.llm.jaccard_join import keep_first
from meterflow.llm.line_quality import THRESHOLD, fit, score_column
from meterflow.llm.queries import fresh_index, tokenizer_path
from meterflow.llm.sentencepiece_codec import Model, encode_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier accepts."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    if model is None:  # nothing to learn from: nothing to reject
        return docs
    return docs.where(score_column(model, F.col("text")) >= THRESHOLD)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return keep_one(docs, fresh_index(spark))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8, the one with the smallest id."""
    return keep_first(docs, k=5, percent=80)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_ids, ids`` of every document that is left."""
    out = encode_documents(docs, Model(tokenizer_path()))
    return out.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids")


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_free),
    ("SentencePiece", tokens),
]

# The classifier and the exact Jaccard groups are beyond SQL; tests/llm compares
# the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{i}")
    return docs
