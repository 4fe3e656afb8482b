"""Corpus preparation: five stages over the table ``documents``, each on what the one before kept.

Language ID drops documents without a recognisable language; line de-duplication cuts
repeated lines out of the texts; near-duplicate removal keeps one document of each class;
personal data is masked; packing encodes the texts and packs their ids into sequences.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockwise.llm import dartminhash, langid, line_dedup, packing, pii
from blockwise.llm.common import materialize, tokenizer_file

#: Byte-level BPE and near-duplicate classes have no SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None

#: Pieces of text that a worker of ``pack`` keeps the ids of: by then the stages before have grown the executor's heap, so fewer than in operator 8 alone.
CACHE_CHUNKS = 150_000


def _recounted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(line_dedup.dedup_lines(docs, short_repeats=True))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dartminhash.keep_first(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recounted(pii.mask_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a sequence, with its ids as little-endian u32 bytes."""
    return packing.pack(docs, "doc_id", "text", tokenizer_file("byte_bpe_50k.json"), 1, cache_chunks=CACHE_CHUNKS).withColumnRenamed("id", "doc_id")


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are a table in the shared folder that the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
