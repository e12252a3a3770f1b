"""Registered queries of the training-data operators, one per operator."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm.common import table


def fresh_index(spark: SparkSession) -> str:
    """Name of a digest index that does not exist yet, in the current database."""
    return f"digest_index_{uuid.uuid4().hex[:12]}"


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.warc import archive_and_read

    return archive_and_read(table(spark, sf_dir, "pages"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.exact_dedup import dedup_batch

    return dedup_batch(table(spark, sf_dir, "documents"), fresh_index(spark))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.chat_format import format_turns, masked_text, read_back

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(tricky).alias("text"),
    )
    out = format_turns(rows.unionByName(extra))
    out = out.withColumn("back", read_back(F.col("formatted"))).withColumn("masked", masked_text(F.col("segments")))
    said = F.array_join(F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("back").cast("bigint").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("masked").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("masked").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "valid",
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.jaccard_join import similar_components

    out = similar_components(table(spark, sf_dir, "documents"), k=3, percent=90)
    return out.select("doc_id", "n_shingles", "component_id")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.substring_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.line_quality import score_documents

    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.pii import KINDS, find_pii, spans_text

    out = find_pii(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")

    return out.select(
        "doc_id",
        *[count(k) for k in KINDS[:4]],
        F.sha2(spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.html_text import extract_pages

    return extract_pages(table(spark, sf_dir, "pages"))


def tokenizer_path() -> str:
    return os.environ.get("METERFLOW_PIECES", "/opt/tokenizers/piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    from meterflow.llm.sentencepiece_codec import BLANK, Model, encode_documents

    model = Model(model_path or tokenizer_path())
    out = encode_documents(table(spark, sf_dir, "documents"), model, decode=True)
    plain = F.replace(F.coalesce("text", F.lit("")), F.lit(BLANK), F.lit(" "))
    return out.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_ids"),
        "ids",
        (F.col("decoded") == plain).alias("round_trip"),
    )


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.decontaminate import find_matches

    return find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.lexical_search import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("item_id", "rank", "doc_id", "score")


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.secret_scan import KINDS, find_secrets, spans_text

    out = find_secrets(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")

    return out.select(
        "doc_id",
        *[count(k) for k in KINDS[:3]],
        F.sha2(spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.sort_array(F.concat("base", "added"))).alias("spans"),
    )


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from meterflow.llm.importance import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


REGISTRY = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_warc": op2_warc,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_chat_format": op4_chat_format,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_line_quality": op7_line_quality,
    "op8_decontaminate": op8_decontaminate,
    "op9_pii": op9_pii,
    "op10_html_text": op10_html_text,
    "op11_search": op11_search,
    "op12_secrets": op12_secrets,
    "op13_importance": op13_importance,
}
