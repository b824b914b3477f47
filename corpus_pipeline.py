"""From raw documents to packed training sequences: toxicity, line dedup, near-dedup, secret scans, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; between stages the rows are written as
Parquet and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm._common import stash
from panelspark.llm.line_dedup import dedup_lines
from panelspark.llm.minhash import keep_one
from panelspark.llm.packing import pack_documents
from panelspark.llm.secret_scan import redact
from panelspark.llm.toxicity import fit_toxicity


def _recounted(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars of the texts as they are now."""
    if "n_chars" not in docs.columns:
        return docs
    n = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return docs.select(*(F.coalesce(n, F.col(c)).alias(c) if c == "n_chars" else c for c in docs.columns))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grading model does not reject."""
    return fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).keep_clean(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that occur earlier; one of which nothing is left by that goes."""
    return _recounted(dedup_lines(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked."""
    return _recounted(redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequence and offset."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("packing", packing)]

#: The model of the first stage and the sketches of the third have no SQL form: the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
