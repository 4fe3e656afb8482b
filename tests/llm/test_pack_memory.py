"""What the packing stage keeps in Python workers."""

import corpus_pipeline
import pyarrow as pa
from pyspark.sql import SparkSession

from blockwise.llm import chunks, packing
from blockwise.llm.common import tokenizer_file


def test_a_small_table_of_pieces_gives_the_same_rows(spark):
    docs = spark.createDataFrame([(k, None if k == 3 else " ".join(f"word{k}x{i} and" for i in range(40 * k))) for k in range(30)], "doc_id long, text string")
    path = tokenizer_file("byte_bpe_50k.json")
    whole = packing.pack(docs, "doc_id", "text", path, 1).orderBy("id", "start").collect()
    assert packing.pack(docs, "doc_id", "text", path, 1, cache_chunks=1).orderBy("id", "start").collect() == whole
    assert corpus_pipeline.CACHE_CHUNKS < chunks.CACHE_CHUNKS


def test_rules_need_no_python_workers(spark, monkeypatch):
    """A list of rows would start workers of another kind, which stay beside those of the operators."""
    docs, given, create = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), [], SparkSession.createDataFrame
    monkeypatch.setattr(SparkSession, "createDataFrame", lambda self, data, *a, **k: given.append(type(data)) or create(self, data, *a, **k))
    assert packing.pack(docs, "doc_id", "text", tokenizer_file("byte_bpe_50k.json"), 1).count() == 1
    assert given == [pa.Table]
