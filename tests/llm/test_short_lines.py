"""Exact repeats of lines under the word minimum."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from blockwise.llm import line_dedup

from test_document_operators import edit1


def model(docs):
    """Any line that is not blank goes if it came before; from five words on also if a line one edit away did."""
    seen, out = set(), {}
    for key, text in docs:
        kept = []
        for raw in text.split("\n"):
            words = tuple(raw.split())
            if words and (words in seen or len(words) >= 5 and any(len(w) >= 5 and edit1(words, w) for w in seen)):
                seen.add(words)
                continue
            if words:
                seen.add(words)
            kept.append(raw)
        out[key] = "\n".join(kept)
    return out


def random_docs():
    rng, docs = random.Random(15), [(0, "Les.\n\nHome  page\nLes."), (1, "Les.\n \nhome page\nHome page"), (2, "")]
    for i in range(3, 60):
        docs.append((i, "\n".join(" ".join(rng.choice("abc") for _ in range(rng.randint(0, 8))) for _ in range(rng.randint(1, 8)))))
    return docs


def test_short_repeats_equal_model(spark):
    docs = random_docs()
    got = dict(line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), short_repeats=True).collect())
    assert got == model(docs)
    assert got[0] == "Les.\n\nHome  page" and got[1] == " \nhome page"


def test_short_repeats_past_the_bit_table(spark, monkeypatch):
    monkeypatch.setattr("blockwise.llm.common.BIT_TABLE_KEYS", 0)
    docs = random_docs()
    got = dict(line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), short_repeats=True).collect())
    assert got == model(docs)


def test_pipeline_drops_short_repeats(spark):
    docs = spark.createDataFrame([(0, "Imprint\nfirst text"), (1, "second text\nImprint")], "doc_id long, text string")
    got = dict(dict(corpus_pipeline.STAGES)["lines"](spark, docs, "").collect())
    assert got == {0: "Imprint\nfirst text", 1: "second text"}


def test_lines_are_normalised_once_a_pass(spark):
    """A filter on a line's hash does not normalise the line again for each time that it names it."""
    docs = spark.createDataFrame([(1, "a  b c d e\r\n\tf g h i j ", 5), (2, None, 6)], "id long, text string, th long")
    lines = line_dedup._lines(docs)
    plan = lines.filter(F.col("h1") % 7 != F.col("h1") % 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1
    assert [r["line"] for r in lines.orderBy("pos").collect()] == ["a b c d e", "f g h i j"]
