"""The pipeline's stages on a small corpus, each held against what its operator should leave."""

import sys

import corpus_pipeline
from blockwise.llm import queries



def rows_of(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def test_stages(spark, tmp_path):
    base = " ".join(f"word{k} and" for k in range(40))
    rows = [(0, base, "en", "s", 1), (1, base, "en", "s", 1), (2, "mail me at a.b@c.org or stay here please now", "en", "s", 1), (3, "123 456", "en", "s", 1), (4, None, "en", None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    stage = dict(corpus_pipeline.STAGES)
    spoken = stage["language"](spark, docs, str(tmp_path))
    assert sorted(r["doc_id"] for r in spoken.collect()) == [0, 1, 2]
    lines = stage["lines"](spark, spoken, str(tmp_path))
    texts = rows_of(lines)
    assert texts[0] == base and texts[1] == ""
    assert rows_of(stage["near_duplicates"](spark, spoken, str(tmp_path))).keys() == {0, 2}
    assert rows_of(stage["personal_data"](spark, spoken, str(tmp_path)))[2] == "mail me at <EMAIL> or stay here please now"
    for name in ("language", "lines", "near_duplicates", "personal_data"):
        assert stage[name](spark, spoken, str(tmp_path)).columns == docs.columns
    packed = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert set(packed["doc_id"]) == {0, 1, 2} and (packed["length"] <= 2048).all()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "personal_data", "pack"]


def test_one_query_per_operator():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]
    assert set(queries.oracle_sql()) <= set(names)
    assert "corpus_pipeline" in sys.modules
