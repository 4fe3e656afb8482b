"""Seeds with spaces, their contexts, and masks of spans that overlap."""

from pyspark.sql import functions as F

from blockwise.llm import pii


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r["id"]: r["spans"] for r in pii.report(docs).collect()}
    return spans, dict(pii.mask_documents(docs).collect())


def test_seeds_with_spaces_are_whole(spark):
    texts = [f"some phone: +1 (017) 555-77{i:02} today" for i in range(12)] + [f"use card= 4111 1111 1111 {n}" for n in (1111, 1129, 1137, 1145, 1152, 1160)]
    k = len(texts)
    texts += ["other phone: 017 555 9911, and 3 more", "one phone: (017) 555-9912 x 5", "use card= 4111 1111 1111 1112 now", "a phone: 44", "that phone: 017 10.0.0.1 there"]
    spans, masked = found(spark, texts)
    assert spans[3] == "phone:12:29" and spans[13] == "card:10:29"
    assert masked[k] == "other phone: <LEARNED>, and 3 more"
    assert masked[k + 1] == "one phone: (<LEARNED> x 5"
    assert masked[k + 2] == "use card= <LEARNED> now"
    assert masked[k + 3] == "a phone: <LEARNED>" and masked[k + 4] == "that phone: <LEARNED> <IP> there"


def test_a_country_code_is_no_seed(spark):
    texts = [f"code: u{i}@mail.org" for i in range(5)] + ["code: +1 (017) 555-7713"] + ["code: 1 thing"] * 14 + ["code: ZZ-9"]
    spans, _ = found(spark, texts)
    assert spans[5] == "phone:6:23" and spans[len(texts) - 1] == "" and spans[6] == ""


def test_one_number_written_in_many_ways_is_one_seed(spark):
    written = ["+1 (017) 555-7713", "+1 017 555 7713", "+1-017-555-7713", "+10175557713", "+1.017.555.7713", "+1 017 5557713"]
    spans, _ = found(spark, [f"my phone: {w}" for w in written] + ["my phone: AB-7"])
    assert spans[6] == ""


def test_long_runs_of_digit_groups(spark):
    texts = [f"my phone: +1 (017) 555-77{i:02}" for i in range(6)] + ["my phone: " + "1 " * 20_000]
    spans, _ = found(spark, texts)
    assert spans[6] == "learned:10:40009"


def test_overlapping_spans_are_masked_whole(spark):
    texts = ["from 10.0.0.21 9807915762804490 on", "call +1 555 123 4567@x.org now", "no 10.0.0.1 10.0.0.2 here", "10.0.0.21 9807915762804490, 10.0.0.5"]
    spans, masked = found(spark, texts)
    assert spans[0] == "ip:5:14,card:12:31" and masked[0] == "from <IP> on"
    assert masked[1] == "call <PHONE> now" and masked[2] == "no <IP> <IP> here" and masked[3] == "<IP>, <IP>"


def test_cues_may_hold_a_number_sign(spark):
    texts = [f"my acct# u{i}@mail.org x" for i in range(6)] + [f"ticket # v{i}@mail.org x" for i in range(6)] + ["my acct# AB-4471 x", "ticket # 123"]
    spans, _ = found(spark, texts)
    assert spans[12] == "learned:9:16" and spans[13] == "learned:9:12"


def test_a_single_left_word_is_one_pattern(spark):
    rows = pii.identifiers(F.col("text"))
    docs = spark.createDataFrame([(" a 1",), ("5 b c 2",), ("3",), ("# 4",)], "text string")
    got = [[(x["value"], x["left1"], x["left2"]) for x in r[0]] for r in docs.select(rows).collect()]
    assert got == [[("1", "a", None)], [("2", "c", "b c")], [], [("4", "#", None)]]


def test_cues_with_digits_and_long_cues(spark):
    long = "c" * 90 + ":"
    texts = [f"acct1 u{i}@mail.org" for i in range(8)] + [f"{long} v{i}@mail.org" for i in range(8)] + [f"account 5: w{i}@mail.org" for i in range(8)]
    spans, _ = found(spark, texts + ["acct1 ZZ-55", f"{long} AB-9", "my account 5: AB-77"])
    assert (spans[24], spans[25], spans[26]) == ("learned:6:11", "learned:92:96", "learned:14:19")


def test_left_words_are_the_words_before(spark):
    texts = ["a1 b2 c3 d", "x a1\t b2  y c3", "A1", "k a1 22 33 (4) w 5", "Ünit\n7 " * 3 + "q" * 500 + " 8"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for i, got in docs.select("id", pii.identifiers(F.col("text"))).collect():
        for x in got:
            words = texts[i][:x["start"]].lower().split()
            assert x["left1"] == words[-1] and x["left2"] == (" ".join(words[-2:]) if len(words) > 1 else None)
            assert texts[i][x["start"]:x["end"]] == x["value"]
        assert len(got) == (2, 3, 0, 2, 4)[i]
