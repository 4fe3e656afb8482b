"""Line and document de-duplication, language, quality, personal data, fixity and vector search against plain models."""

import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockwise.llm import dartminhash, divergence, fixity, langid, line_dedup, pii, vptree

from odd_rows import no_docs, odd_docs  # noqa: E402, F401


def edit1(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def model_lines(docs):
    seen, out = {}, {}
    for key, text in docs:
        kept = []
        for raw in text.split("\n"):
            words = tuple(raw.split())
            if len(words) >= 5 and any(edit1(words, w) for w in seen):
                seen.setdefault(words, 1)
                continue
            if len(words) >= 5:
                seen[words] = 1
            kept.append(raw)
        out[key] = "\n".join(kept)
    return out


def test_line_dedup_equals_model(spark):
    rng, docs = random.Random(5), []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(1, 8)):
            words = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
            lines.append(" ".join(words))
        docs.append((i, "\n".join(lines)))
    base = [f"w{k}" for k in range(40)]
    for i in range(60, 100):  # many variants of one line
        line = list(base)
        line[rng.randrange(40)] = f"v{i}"
        docs.append((i, " ".join(line)))
    got = dict(line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == model_lines(docs)


def test_line_dedup_odd_rows(odd_docs, no_docs):
    got = line_dedup.dedup_lines(odd_docs)
    assert got.columns == odd_docs.columns and got.count() == odd_docs.count()
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert texts[0] is None and texts[1] == "" and texts[3] in ("\n\n", "another text of the same id") and texts[6] == "word " * 6_000
    assert line_dedup.dedup_lines(no_docs, counts=True).count() == 0


def classes(texts, threshold=0.8):
    sets = {k: set(dartminhash.shingles(t)[0].tolist()) for k, t in texts.items() if t is not None}
    root = {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(sets, 2):
        same = texts[a] == texts[b]
        if same or sets[a] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: find(k) for k in texts}


def test_near_duplicates_equal_model(spark):
    rng, texts = random.Random(9), {}
    for g in range(12):
        words = [f"g{g}w{k}" for k in range(120)]
        for _ in range(rng.randint(1, 9)):
            copy = list(words)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(120)] = f"x{rng.random()}"
            texts[len(texts)] = " ".join(copy)
    texts |= {900: None, 901: None, 902: "", 903: "", 904: "two words", 905: "two words", 906: "two  words", 907: texts[0]}
    got = {r["id"]: r["class_id"] for r in dartminhash.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == classes(texts)


def test_strangers_in_a_bucket_are_compared_only_if_they_can_be_near(spark, monkeypatch):
    rng, made, keep = random.Random(5), {}, dartminhash.materialize
    base = [f"w{i}" for i in range(60)]
    texts = {i: " ".join(f"x{rng.random()}" if rng.random() < 0.04 else w for w in base) for i in range(120)}

    def counted(df, name, *args):
        made[name] = keep(df, name, *args)
        return made[name]

    monkeypatch.setattr(dartminhash, "materialize", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    dartminhash.near_duplicates(docs).count()
    sets = {k: set(dartminhash.shingles(t)[0].tolist()) for k, t in texts.items()}
    near = {(a, b) for a, b in itertools.combinations(texts, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    compared = {(r["a"], r["b"]) for r in made["strangers"].collect()}
    assert compared <= {(a, b) for a, b in itertools.combinations(texts, 2) if len(sets[a] & sets[b]) >= 0.7 * len(sets[a] | sets[b])}
    assert {(r["a"], r["b"]) for r in made["links"].select("a", "b").collect()} <= near


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    elements, a, b = rng.integers(0, 2**63, 200, dtype=np.uint64), rng.integers(1, 9, 200), rng.integers(1, 9, 200)
    s = dartminhash.signatures([(elements, a), (elements, b), (elements[:0], a[:0])], 4096)
    assert abs((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04
    assert not s[2].any()


def test_keep_first_odd_rows(odd_docs, no_docs):
    kept = dartminhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(4) == 1 and 100 not in ids and {None, 0, 1, 5, 6, 101} <= set(ids) and ids.count(3) == 1
    assert dartminhash.near_duplicates(no_docs).count() == 0


def test_language(spark, odd_docs, no_docs):
    rng = random.Random(3)
    words = {"aa": ["the", "house", "water"], "bb": ["das", "haus", "wässer"], "cc": ["casa", "niño", "agua"]}
    rows = [(i, " ".join(rng.choice(words[x]) for _ in range(20)), x) for i in range(300) for x in [rng.choice("abc") * 2]]
    rows += [(1000, None, "aa"), (1001, "123 !!", "bb"), (1002, "the water", None)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).toPandas().set_index("id")
    assert all(got.loc[i, "lang_pred"] == x for i, _, x in rows[:300]) and got["held_out"].any()
    assert got.loc[1000, "lang_pred"] == got.loc[1001, "lang_pred"] == "und" and got.loc[1002, "lang_pred"] == "aa"
    assert got["score"].between(0, 1).all()
    assert langid.identify(odd_docs).count() == odd_docs.count()
    assert langid.keep_identified(odd_docs).columns == odd_docs.columns
    assert langid.identify(no_docs).count() == 0


def test_codewords():
    for k in (1, 2, 3, 6, 7, 30):
        code = langid.codewords(k)
        assert code.shape[0] == k and len({tuple(r) for r in code.tolist()}) == k


def model_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:]))
    covered = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_counts(spark, odd_docs, no_docs):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab #*\n\t\x85 é") for _ in range(rng.randint(0, 200))) for _ in range(80)] + ["a a a a", "a b c a b c", None]
    for t in texts:
        assert divergence.word_stats(t)[0] == model_quality(t), repr(t)
    got = divergence.quality(odd_docs).toPandas()
    assert len(got) == odd_docs.count() and (got[got["n_words"] < 50]["base_failed"]).all() and not (got["base_failed"] & got["kept"]).any()
    assert divergence.quality(no_docs).count() == 0


def test_distance():
    p = np.array([1.0, 0, 0])
    assert divergence.distance(p, p) == 0 and divergence.distance(p, np.array([0, 2.0, 0])) == 1 and divergence.distance(p, p * 0) == 1


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0


def model_spans(text):
    rules = ((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
             (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
             (r"[0-9]([\x20-]?[0-9])+", lambda v: 14 <= len(re.sub(r"\D", "", v)) <= 19 and luhn(re.sub(r"\D", "", v))),
             (r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 10 <= len(re.sub(r"\D", "", v)) <= 15))
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(rules) for m in re.finditer(p, text or "") if ok(m[0]))


def test_base_spans_equal_model(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("01 12-.+@aB()\n") for _ in range(400)) for _ in range(60)]
    texts += ["a@b.c_d@e.f.g", "1.2.3.4.5.6.7.8 0.0.0.0255 256.1.1.1", "x" * 3000 + "@", "4111 1111 1111 1111 4111-1111-1111-1111 22",
              "+1 (234) 567-8901.+44 20 7946 0958-", "é😀 a.b@c.de 😀 10.0.0.1", "1 " * 3000, "9" * 3000, None, "", "1.1.1." * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for i, spans in df.select("id", pii.base_spans(F.coalesce("text", F.lit("")))).collect():
        assert [tuple(s) for s in spans] == model_spans(texts[i]), repr(texts[i][:80])


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"some text account: user{i}@mail.org and {i} more") for i in range(12)]
    rows += [(50, "plain account: XK-99-1234, end of the 77 line"), (51, "the 77 line without an account here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["id"]: r["spans"] for r in pii.report(docs).collect()}
    assert got[50] == "learned:15:25" and got[51] == "" and got[3] == "email:19:33"
    masked = dict(pii.mask_documents(docs).collect())
    assert masked[50] == "plain account: <LEARNED>, end of the 77 line" and masked[3] == "some text account: <EMAIL> and 3 more"


def test_personal_data_odd_rows(odd_docs, no_docs):
    assert pii.report(odd_docs).count() == odd_docs.count()
    masked = pii.mask_documents(odd_docs)
    assert masked.columns == odd_docs.columns
    assert sorted(str(r["text"]) for r in masked.collect()) == sorted(str(r["text"]) for r in odd_docs.collect())
    assert pii.report(no_docs).count() == 0


def test_fixity_audit_equals_comparison(spark):
    rng = random.Random(6)
    master = [(shard, offset, 50, None, f"{rng.random()}") for shard in (0, 1, None) for offset in range(0, 40_000, 50)]
    copy = [(s, o, n, i, "bad" if o % 9950 == 0 else d) for s, o, n, i, d in master if o != 777 * 50 and s is not None]
    copy += [(1, 13, 1, None, "new"), (1, 39_950, 50, None, "second at one offset"), (5, 0, 1, None, "other shard")]
    schema = "shard long, offset long, length long, record_id long, sha256 string"
    a, b = (spark.createDataFrame([(s if s is not None else -1, *r) for s, *r in x], schema) for x in (master, copy))
    got = {tuple(r) for r in fixity.audit(a, b, block=512, fanout=4).collect()}

    def grouped(rows):
        out = {}
        for s, o, n, _, d in rows:
            out.setdefault((s if s is not None else -1, o), []).append((n, d))
        return {k: sorted(v) for k, v in out.items()}

    x, y = grouped(master), grouped(copy)
    want = {(*k, "missing" if k not in y else "extra" if k not in x else "altered") for k in x.keys() | y.keys() if x.get(k) != y.get(k)}
    assert got == want
    assert fixity.audit(a, a, block=512, fanout=4).count() == 0
    assert fixity.audit(a.limit(0), b.limit(0)).count() == 0


def test_fixity_layout(spark):
    pages = spark.createDataFrame([(1, "u", "é"), (1, "u", "é"), (2, None, None), (None, "v", "x"), (None, None, None)], "page_id long, url string, html string")
    laid = fixity.lay_out(pages, "page_id", fixity.warc_record(F.col("url"), F.col("html"))).orderBy("shard", "offset").collect()
    assert sum(r["shard"] < 0 for r in laid) == 2
    first, second = [r for r in laid if r["shard"] == 0]
    assert first["record_id"] == 1 and second["offset"] == first["length"] and first["length"] % 2 == 0


@pytest.mark.parametrize("factor", [1.0, 1.1])
def test_neighbours(spark, factor):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 16))
    vectors = [(i, (centres[i % 12] + 0.3 * rng.normal(size=16)).tolist()) for i in range(900)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(40)]  # ties
    odd = [(2000, None), (2020, []), (2040, [0.0] * 16), (2060, [math.nan] * 16), (2080, [None] * 16), (2100, [math.inf] * 16), (2120, [1.0, 2.0]), (None, [1.0] * 16)]
    df = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS shard", "'y' AS v")
    got = vptree.nearest(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, factor=factor, shard_rows=300, block_queries=20).collect()
    by = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        by.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    v = dict(vectors)
    hits = total = 0
    for q in (i for i, _ in vectors if i % 20 == 0):
        scores = [(-sum(x * y for x, y in zip(v[q], w)), i) for i, w in vectors if i != q]
        want = [i for _, i in sorted(scores)[:20]]
        hits, total = hits + len({i for i, _ in by[q]} & set(want)), total + 20
        if factor == 1.0:
            assert [i for i, _ in by[q]] == want
    assert hits / total >= 0.9 and not set(by) & {2000, 2020, 2040, 2060, 2080, 2100, 2120}
    assert vptree.nearest(df.limit(0), "vec_id", "embedding", F.lit(True)).count() == 0


def test_neighbours_beside_huge_components(spark):
    vectors = [(i, [math.sin(i), math.cos(3 * i)]) for i in range(400)]
    huge = [(1000, [1e200, 1.0]), (1001, [-1e200, 1e200])]
    frame = spark.createDataFrame(vectors + huge, "vec_id long, embedding array<double>")
    got = {}
    for r in sorted(vptree.nearest(frame, "vec_id", "embedding", F.col("vec_id") % 20 == 0, k=5, factor=1.0, shard_rows=150).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    rows = dict(vectors + huge)
    for q in [i for i in rows if i % 20 == 0]:
        product = lambda v: sum(a * b for a, b in zip(rows[q], v))
        want = sorted((i for i in rows if i != q), key=lambda i: (-product(rows[i]), i))
        assert got[q] == want[:5]


def test_references_and_documents_split_words_alike(spark):
    """Words end at the six ASCII spaces alone, in references and in documents."""
    from blockwise.llm import divergence
    text = "One\u00a0two three\x1cfour. \x0bFive\u2003six " * 3
    refs = divergence.references(spark.createDataFrame([(1, text, "xx")], "doc_id long, text string, lang string"), "text", "lang")
    counts = divergence.word_stats(text)[1]
    assert dict(zip(refs["xx"][1], refs["xx"][2].tolist())) == counts
