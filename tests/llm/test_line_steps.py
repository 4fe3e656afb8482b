"""Half keys of lines: their steps, and that they are worked out once a line."""

import math

from pyspark.sql import functions as F

from blockwise.llm import line_dedup


def test_steps_are_the_largest_up_to_half_of_the_words(spark):
    steps = sorted({2 ** k for k in range(14)} | {3 * 2 ** k for k in range(13)})
    found = spark.range(0, 9000).select("id", line_dedup._half(F.col("id").cast("int")).alias("c")).collect()
    assert {r["id"]: r["c"] for r in found} == {n: max(s for s in steps if s <= max(1, math.floor(n / 2))) for n in range(9000)}


def test_lines_of_many_lengths_are_still_found_alike(spark):
    lines = [[f"w{n}x{i}" for i in range(n)] for n in range(5, 60)]
    first = "\n".join(" ".join(x) for x in lines)
    edited = "\n".join(" ".join([*x[:n % len(x)], "new", *x[n % len(x) + n % 2:]]) for n, x in enumerate(lines, 5))
    docs = spark.createDataFrame([(1, first), (2, edited), (3, "é " * 6)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs, counts=True).collect()}
    assert (rows[1]["n_dropped"], rows[2]["n_dropped"], rows[3]["n_dropped"]) == (0, 55, 0)
    assert rows[1]["text"] == first and rows[2]["text"] == ""
