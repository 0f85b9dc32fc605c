"""Corpus preparation as a chain of stages over ``documents``.

Each stage is written as Parquet to the shared folder and read again as the
next one's input.  Stages 1 to 4 return the columns of documents; the last
writes the token store and returns its index (doc_id, start, n_tokens,
ids_crc32, place).  Documents that the mix repeats occur once for each copy.

The store keeps the training order.  The mix adds no column, so the order is
that of its written rows: the part number of a file, then the row in it (the
mix is range-sorted, so part numbers follow it).  ``place`` counts the copies
before a copy in that order.

Defined results: an empty table gives an empty result in every stage; documents
with a null or empty text fail the quality rules; rows with a null doc_id are no
near copies of others; repeated rows are near copies of each other where they
have different ids, and rows of one id share its verdict; ties in the training
order are broken by a hash of all columns; extra columns of any name are carried
up to the mix.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventide.llm import curriculum, decontaminate, minhash_bayes, quality_cascade, token_store
from eventide.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every rule of the cascade."""
    return quality_cascade.kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (five-word shingles, similarity 0.8)."""
    return minhash_bayes.kept_rows(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with ``benchmark``."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def curriculum_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, repeated or left out to meet their source's target, in training order."""
    return curriculum.training_order(docs)


def _written_order(docs: DataFrame) -> list[Column]:
    """The order in which the rows of a Parquet folder were written; rows of another frame as they come."""
    file = F.col("_metadata.file_name")
    order = [F.regexp_extract(file, r"^part-(\d+)", 1).try_cast("long"), file, F.col("_metadata.row_index")]
    try:
        docs.select(*order).schema
    except AnalysisException:
        return [F.monotonically_increasing_id()]
    return order


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Index of the token store, written in the order of the rows and read back from its blocks."""
    path = scratch_path(spark, "pipeline-tokens")
    token_store.write(docs, path, order=_written_order(docs))
    return token_store.read_index(spark, path, place=True)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("curriculum_mix", curriculum_mix), ("token_output", token_output)]

#: Tokenization has no SQL form; the pipeline is tested against brute-force stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, in order."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"pipeline-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
