"""Keyword matching, zone rates, top-k and the golden line format."""

from pyspark.sql import functions as F

from blockwise.operators import keywords as K
from blockwise.operators import ranking as R

TEXTS = [
    (1, "buy some oxy today"),        # hit
    (2, "nothing to see"),            # miss
    (3, "OXY in caps"),               # upper-case: no match
    (4, "double  space"),             # matches the blank term
    (5, "crack cocaine again"),       # multi-word term never matches
    (6, "oxy"),                       # whole text is the term
    (7, None),
]
TERMS = ["oxy", "", "crack cocaine"]


def test_has_any_term(spark):
    df = spark.createDataFrame(TEXTS, "id int, text string")
    hits = sorted(r["id"] for r in K.keyword_filter(df, "text", TERMS).collect())
    assert hits == [1, 4, 6]
    no_blank = sorted(r["id"] for r in K.keyword_filter(df, "text", ["oxy", "crack cocaine"]).collect())
    assert no_blank == [1, 6]


def test_semi_join_equals_filter_and_union_terms(spark):
    df = spark.createDataFrame(TEXTS, "id int, text string")
    l1 = spark.createDataFrame([("oxy",), ("",)], "value string")
    l2 = spark.createDataFrame([("crack cocaine",)], "value string")
    terms = K.union_terms(l1, l2)
    semi = sorted(r["id"] for r in K.keyword_semi_join(df, "text", terms, keep=["id"]).collect())
    assert semi == [1, 4, 6]
    assert sorted(K.terms_from_frame(terms)) == sorted(TERMS)


def test_long_word_list_is_joined(spark):
    terms = spark.createDataFrame([(f"w{i}",) for i in range(500)] + [("b",), (None,)], "value string")
    assert K.terms_from_frame(terms, max_bytes=100) is None
    posts = spark.createDataFrame([(1, "a b", "x"), (2, "ab", None), (3, None, "y"), (4, "a b", "z"), (5, "w499 w499", "")],
                                  "id int, text string, th1 string")
    joined = K.keyword_filter(posts, "text", terms, max_bytes=0)
    assert joined.columns == posts.columns
    assert sorted(r["id"] for r in joined.collect()) == [1, 4, 5]
    assert sorted(r["id"] for r in K.keyword_filter(posts, "text", terms).collect()) == [1, 4, 5]


def test_zone_rate(spark):
    counts = spark.createDataFrame([(0, 5), (1, 3), (2, 4)], "zone_id long, n long")
    pop = spark.createDataFrame([(0, 10), (1, 0)], "zone_id long, population long")
    got = {r["zone_id"]: r["rate"] for r in K.zone_rate(counts, pop).collect()}
    assert got == {0: 0.5, 1: None, 2: None}   # zone 0 kept; population 0 / missing -> null


PAIRS = [("Bronx", "Mott Haven", 1357), ("Bronx", "Castle Hill", 1305), ("Bronx", "Parkchester", 986),
         ("Bronx", "Fordham", 10), ("Queens", "Astoria", 7), ("Queens", "Corona", 7),
         ("Queens", "Anora", 7), ("Queens", "Zed", 9), ("Staten Island", "Emerson Hill", 63)]


def test_top_k_ties_and_short_groups(spark):
    df = spark.createDataFrame(PAIRS, "group_name string, zone_name string, n long")
    got = [(r["group_name"], r["rank"], r["zone_name"]) for r in
           R.top_k(df, "group_name", k=3).orderBy("group_name", "rank").collect()]
    assert got == [("Bronx", 1, "Mott Haven"), ("Bronx", 2, "Castle Hill"), ("Bronx", 3, "Parkchester"),
                   ("Queens", 1, "Zed"), ("Queens", 2, "Anora"), ("Queens", 3, "Astoria"),
                   ("Staten Island", 1, "Emerson Hill")]


# The golden line format of the zone-pair job (one result line).
GOLDEN = "Bronx,[('Mott Haven', 1357), ('Castle Hill', 1305), ('Parkchester', 986)]"


def test_golden_line_format(spark):
    df = spark.createDataFrame(PAIRS, "group_name string, zone_name string, n long")
    lines = R.format_topk_lines(R.nest_top_k(R.top_k(df, "group_name", k=3), "group_name"),
                                "group_name").collect()
    assert [r["group_name"] for r in lines] == ["Bronx", "Queens", "Staten Island"]
    assert lines[0]["line"] == GOLDEN
    assert lines[2]["line"] == "Staten Island,[('Emerson Hill', 63)]"


def test_python_repr_quoting(spark):
    df = spark.createDataFrame([("O'Neil",), ("plain",), ("a\\b",)], "s string")
    got = [r[0] for r in df.select(R.py_str_literal(F.col("s"))).collect()]
    assert got == [repr("O'Neil"), repr("plain"), repr("a\\b")]


def test_limit_sorted(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(50)], "k int, v double")
    got = [r["k"] for r in R.limit_sorted(df, [F.col("v").desc(), F.col("k")], 3).collect()]
    assert got == [6, 13, 20]


def test_rate_lines(spark):
    from blockwise.plans.jobs import keyword_rate_lines
    rates = spark.createDataFrame([(2, 0.25), (0, 0.5), (1, None)], "zone_id long, rate double")
    assert [r["line"] for r in keyword_rate_lines(rates).collect()] == ["0,0.5", "1,", "2,0.25"]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

WORDS = st.sampled_from(["a", "b", "ab", "the", "of", "", "x y", "B"])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab ofthe\\n", max_size=25), min_size=1, max_size=8),
       st.lists(WORDS, min_size=1, max_size=4))
def test_term_test_equals_token_sets(spark, texts, terms):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    short = {r["id"] for r in df.where(K.has_any_term("text", terms)).collect()}
    want = {i for i, t in enumerate(texts) if set(t.split(" ")) & set(terms)}
    assert short == want
    many = terms + [f"zz{i}" for i in range(40)]
    assert {r["id"] for r in df.where(K.has_any_term("text", many)).collect()} == want


def test_bloom_filter_keeps_all_keys_and_few_others(spark):
    from blockwise.operators.bloom import bloom_test, filter_words
    keys = spark.range(20_000).select(F.concat(F.lit("w"), "id").alias("k"))
    values = spark.range(40_000).select("id", F.concat(F.lit("w"), "id").alias("v"))
    passed = values.where(bloom_test(keys)(F.col("v")))
    assert passed.where("id < 20000").count() == 20_000
    assert passed.where("id >= 20000").count() < 600          # 1.2 % expected: 240
    assert filter_words(10**12) * 8 == 8 << 20                # bounded, whatever the number of keys
    tight = values.where(bloom_test(keys, max_bytes=1024)(F.col("v")))
    assert tight.where("id < 20000").count() == 20_000        # a full filter only lets more pass
    assert values.where(bloom_test(keys.limit(0))(F.col("v"))).count() == 0


def test_long_list_shuffles_hits_only(spark):
    posts = spark.range(2_000).select("id", F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(49)), lambda i: F.concat(F.lit("t"), F.col("id") * 50 + i))).alias("text"))
    terms = spark.range(0, 100_000, 1_000).select(F.concat(F.lit("t"), "id").alias("term"))
    tokens = K.candidate_tokens(posts, "text", {"id": F.col("id")}, terms)
    assert 100 <= tokens.count() < 100 + 100_000 * 0.03
    got = K.keyword_filter(posts, "text", terms, max_bytes=0)
    assert sorted(r["id"] for r in got.collect()) == list(range(0, 2_000, 20))


def test_salted_top_k_equals_the_plain_one(spark):
    rows = spark.range(3_000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
                                     F.concat(F.lit("z"), "id").alias("zone_name"), (F.col("id") % 11).alias("n"), F.lit("x").alias("salt"))
    order = [F.col("n").desc(), F.col("zone_name").asc()]
    for k in (1, 3, 1500):
        plain, salted = (R.top_k(rows, "g", k=k, order=order, salts=s) for s in (0, 8))
        assert salted.columns == plain.columns
        assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("row_number") >= 2 and "salt" in plan
