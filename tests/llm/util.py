"""Fixtures shared by the training-data tests."""

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_of(spark, pairs, clashing=True):
    """A documents table of (doc_id, text), with extra columns whose names operators use inside."""
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in pairs], DOC_SCHEMA)
    if clashing:
        for name in ("row", "key", "sig", "cid", "tx", "digest", "n", "marks", "at", "root", "value", "base", "ids"):
            df = df.withColumn(name, F.lit("x"))
    return df


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
