"""Periodic runs, cross-tokenizer alignment and the attention model against plain models."""

import bisect
import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockwise.llm import alignment, attention_lm as lm, queries, runs
from blockwise.llm.common import tokenizer_file, tokenizer_pattern
from blockwise.llm.postings import BLOCK_DOCS, Block, incidences, postings, summed

from odd_rows import no_docs, odd_docs  # noqa: E402, F401

A_FILE, B_FILE = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


# -- runs ---------------------------------------------------------------------

def plain_runs(words, least=24, periods=3):
    """For every period the stretches that keep it; a stretch belongs to its smallest period."""
    best, n = {}, len(words)
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, periods * q):
                best.setdefault((start, i - start + q), q)
            i = max(i, start + 1)
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def periodic_text(rng):
    words = []
    for _ in range(rng.randint(0, 6)):
        letters = rng.choice([1, 2, 2, 3, 50])
        part = [b"%d" % rng.randrange(letters) for _ in range(rng.randint(1, 14))]
        words += (part * rng.randint(1, 12))[:rng.randint(1, 120)] if rng.random() < 0.6 else part * 2
    return words


@pytest.mark.parametrize("least, periods", [(24, 3), (10, 4), (3, 3)])
def test_runs_equal_the_plain_search(least, periods):
    rng = random.Random(least)
    texts = [periodic_text(rng) for _ in range(600)] + [[b"a"] * 2_000, [], [b"a"]]
    got = [r for lo in range(0, len(texts), 100) for r in runs.runs_of(texts[lo:lo + 100], least, periods)]
    assert got == [plain_runs(t, least, periods) for t in texts]
    with pytest.raises(ValueError):
        runs.runs_of(texts, 24, 2)


def test_a_phrase_after_many_different_words_is_no_run():
    words = [w for k in range(4_000) for w in (b"%d" % k, *[b"p%d" % i for i in range(20)])]
    assert runs.runs_of([words]) == [[]]


def planted(doc_id, words):
    h, n = (zlib.crc32(str(doc_id).encode()), len(words)) if doc_id is not None else (1, 0)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def plain_op13(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    found = plain_runs(words)
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    top = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    every = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (doc_id, len(found), *(top or (None,) * 3), top and 1000 * top[1] // top[2], hashlib.sha256(every.encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest())


OP13 = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_op13_on_odd_rows(spark, odd_docs, no_docs, tmp_dir):
    many = odd_docs.where("length(text) < 3000 OR text IS NULL").unionByName(
        spark.range(200, 290).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(0, 60 + id), i -> concat('w', i % 13))) AS text"), allowMissingColumns=True)
    many.write.parquet(f"{tmp_dir}/documents.parquet")
    got = queries.op13_maximal_pairs(spark, tmp_dir).select(OP13).collect()
    want = [plain_op13(r["doc_id"], r["text"]) for r in many.collect()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert any(r["n_runs"] for r in got)
    long = odd_docs.select(runs.periodic_runs(F.col("text")).alias("f")).where("f.n_words > 3000").select("f.*").first()
    assert [tuple(r) for r in long["runs"]] == [(0, 6_000, 1)] and long["collapsed"] == "word"
    assert no_docs.select(runs.periodic_runs(F.col("text")).alias("f")).count() == 0


# -- alignment ----------------------------------------------------------------

def plain_groups(text):
    """Groups of a text by the plain library calls, or none."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(A_FILE), SentencePieceProcessor(model_file=B_FILE)
    a.encode_special_tokens = True
    from tokenizers.pre_tokenizers import ByteLevel
    letters = {ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(k))[0][0]: k for k in range(128)}
    byte_of = {c: k for k, c in enumerate(alignment.chunks._byte_letters())}
    assert all(byte_of[c] == k for c, k in letters.items())

    def one(text):
        if not text:
            return []
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        xs = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in x]
        ys = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if not b"".join(xs) == b"".join(ys) == (" " + text).encode():
            return []
        ends = [np.cumsum([len(t) for t in ts]).tolist() for ts in (xs, ys)]
        cuts = sorted({*ends[0]} & {*ends[1]})
        groups = [([], []) for _ in cuts]
        for side, (ids, es) in enumerate(((x, ends[0]), (y, ends[1]))):
            for i, e in zip(ids, es):
                groups[bisect.bisect_left(cuts, e)][side].append(i)
        return groups

    return [one(t) for t in text]


def plain_op12(rows):
    groups = plain_groups([t for _, t in rows])
    links = [[(x, y) for g, h in gs for x in g for y in h] for gs in groups]
    count, best = collections.Counter(), collections.Counter()
    for found in links:
        count.update(set(found))
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    for (i, _), gs, found in zip(rows, groups, links):
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in gs)
        yield (i, sum(len(g) for g, _ in gs), sum(len(h) for _, h in gs), len(gs), len(found), sum(count[p] == best[p[0]] for p in found),
               sum(count[p] for p in found), hashlib.sha256(text.encode()).hexdigest() if text else "")


OP12 = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TRICKY = ["a  b", " lead", "trail ", "a \nb\n c", "<|endoftext|> and <s> </s> <unk> <0x41>", "x▁y", "日本語 テキスト", "é ﬁ ①", "a b   c", "tab\tx\r\ny",
          "​", "😀😀", "İstanbul", "'s it's", "1234567 89,0", "\x00nul", "٣٤", "a" * 300, "é" * 500]


def test_op12_on_odd_rows(spark, odd_docs, no_docs, tmp_dir):
    docs = odd_docs.unionByName(spark.createDataFrame([(1_000 + k, t) for k, t in enumerate(TRICKY)], "doc_id long, text string"), allowMissingColumns=True)
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    got = queries.op12_pair_bitmaps(spark, tmp_dir).select(OP12).collect()
    want = plain_op12([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    rows = alignment.invert(no_docs, "doc_id", "text", A_FILE, B_FILE)
    assert alignment.score_documents(rows, alignment.pair_table(rows)).count() == 0


def test_pair_table_counts_documents_and_links(spark):
    texts = ["the cat the cat the", "the cat", "no such word"]
    rows = alignment.invert(spark.createDataFrame(list(enumerate(texts)), "id long, t string"), "id", "t", A_FILE, B_FILE)
    found = {r["pair"]: (r["n_docs"], r["n_links"]) for r in alignment.pair_table(rows).collect()}
    docs, links = collections.Counter(), collections.Counter()
    for gs in plain_groups(texts):
        pairs = [x << 16 | y for g, h in gs for x in g for y in h]
        docs.update(set(pairs))
        links.update(pairs)
    assert found == {p: (docs[p], links[p]) for p in docs}
    assert rows.where("pair IS NULL AND id = 1").first()["groups"].count("|") == len(plain_groups(["the cat"])[0])


def test_wide_groups_pair_distinct_ids(monkeypatch):
    a, b = alignment.byte_level(A_FILE), alignment.sentence_pieces(B_FILE)
    texts = [" " + "é" * 40, " the thing", " aaaa bb"]
    ids = a.encode(texts), b.encode(texts)
    plain = alignment.align(*ids, a, b)
    monkeypatch.setattr(alignment, "WIDE_GROUP", 0)
    wide = alignment.align(*ids, a, b)
    assert wide.texts == plain.texts and (wide.counts == plain.counts).all()
    for k in range(len(texts)):
        at = [slice(x.starts[k], x.starts[k] + x.sizes[k]) for x in (plain, wide)]
        one, two = (summed(x.pairs[s], x.links[s]) for x, s in zip((plain, wide), at))
        assert (one[0] == two[0]).all() and (one[1] == two[1]).all()


def test_quick_ids_are_the_tokenizers_own():
    from tokenizers import Tokenizer
    rng, tok, a = random.Random(2), Tokenizer.from_file(A_FILE), alignment.byte_level(A_FILE)
    tok.encode_special_tokens = True
    texts = [" " + "".join(rng.choice("abcdefgtheTHE'sdrlv0123456789.,!?<|>_-\n\t\x0b\x1c \x00\x7f") for _ in range(rng.randint(1, 40))) for _ in range(4_000)]
    chunks_ = [c for t in texts for c in alignment.cut(t[1:])]
    ids, counts = a.encode(chunks_)
    assert ids.tolist() == [i for c in chunks_ for i in tok.encode(c, add_special_tokens=False).ids]
    assert counts.tolist() == [len(tok.encode(c, add_special_tokens=False).ids) for c in chunks_]


def test_postings_round_trip():
    import pyarrow as pa
    rng = np.random.default_rng(5)
    block = Block(3)
    keys = np.r_[np.zeros(3_000, np.int64), rng.integers(1, 40, 5_000)]
    docs = np.r_[rng.permutation(BLOCK_DOCS)[:3_000], rng.integers(0, BLOCK_DOCS, 5_000)]
    times = rng.integers(1, 9, len(keys))
    block.add(BLOCK_DOCS, keys, docs, times)
    assert block.room() == 0
    codes, counts = block.close()
    found, n, bitmaps, planes = postings(codes, counts)
    place, doc, back = incidences(n, pa.array(bitmaps, pa.binary()), pa.array(planes, pa.binary()))
    assert max(map(len, bitmaps)) == BLOCK_DOCS // 8 and (found[place] << 12 | doc).tolist() == codes.tolist() and back.tolist() == counts.tolist()


# -- the attention model ------------------------------------------------------

def small_model(n=40, seed=1):
    rng = np.random.default_rng(seed)
    tree = lm.huffman(rng.integers(0, 50, n))
    table = lm.initial_weights(n).astype(np.float64)
    lm.parts(table, n).nodes[:] = rng.normal(0, 0.5, (n - 1, lm.DIMS))
    return rng, tree, table


def test_tree_gives_probabilities_and_the_unigram_at_first():
    rng, tree, table = small_model()
    state = np.repeat(rng.normal(size=(1, lm.DIMS)), 40, 0)
    assert np.exp(lm.path_scores(tree, lm.parts(table, 40).nodes, state, np.arange(40))[0]).sum() == pytest.approx(1)
    counts = np.array([5, 0, 3, 9])
    even = lm.path_scores(lm.huffman(counts), np.zeros((3, lm.DIMS)), np.zeros((4, lm.DIMS)), np.arange(4))[0]
    assert np.exp(even) == pytest.approx((counts + 0.1) / (17 + 0.4), rel=1e-5)


def test_gradients():
    rng, tree, table = small_model()
    inputs, targets = rng.integers(0, 40, (2, 3, lm.WINDOW))
    scored = rng.random((3, lm.WINDOW)) < 0.7
    step = lm.gradients(tree, table, inputs, targets, scored)
    whole = np.zeros_like(table)
    whole[step.rows] = step.gradient
    for _ in range(120):
        at = rng.integers(len(table)), rng.integers(lm.DIMS)
        up, down = table.copy(), table.copy()
        up[at] += 1e-5
        down[at] -= 1e-5
        slope = (lm.gradients(tree, up, inputs, targets, scored).log_probability - lm.gradients(tree, down, inputs, targets, scored).log_probability) / 2e-5
        assert slope == pytest.approx(whole[at], abs=1e-4)


def plain_score(tree, table, ids, end):
    """One id at a time, each from the window that scores it, by loops."""
    w, before, total = lm.parts(table, len(tree.sizes)), [end, *ids], 0.0
    for t in range(len(ids)):
        begin = 0 if t < lm.WINDOW else lm.STRIDE * -(-(t + 1 - lm.WINDOW) // lm.STRIDE)
        x = [w.embed[before[i]] + w.places[i - begin] for i in range(begin, t + 1)]
        weights = [math.exp(float((x[-1] @ w.query) @ (v @ w.key)) / lm.DIMS ** 0.5) for v in x]
        h = x[-1] + sum(a * (v @ w.value) for a, v in zip(weights, x)) / sum(weights) @ w.out
        h = h + np.maximum(w.widen @ h, 0) @ w.narrow
        for k in range(tree.starts[ids[t]], tree.starts[ids[t]] + tree.sizes[ids[t]]):
            z = float(h @ w.nodes[tree.nodes[k]] + tree.bias[tree.nodes[k]]) * float(tree.sides[k])
            total -= math.log1p(math.exp(-z))
    return total


def test_each_id_is_scored_once_with_its_context():
    rng, tree, table = small_model()
    texts = [rng.integers(0, 40, n).tolist() for n in (1, 31, 32, 33, 56, 57, 200)]
    got = lm.score_stream(tree, table, lm.Stream.of([np.array(t, "<u2").tobytes() for t in texts], 39))
    assert got == pytest.approx([plain_score(tree, table, t, 39) for t in texts], rel=1e-5)


def test_every_training_window_is_trained_on(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("".join(rng.choices("abcdefghij", k=4)) for _ in range(30))) for i in range(60)]
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    n_ids = len(lm.read_ranks(path)) + 1
    found = lm.read_corpus(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", path, tokenizer_pattern(), n_ids - 1)
    tree = lm.huffman(lm.id_counts(found, n_ids))
    changed = np.flatnonzero((lm.train(found, tree, n_ids - 1) != lm.initial_weights(n_ids)).any(1))
    texts = [np.frombuffer(r["ids"], "<u2") for r in found.where("doc IS NOT NULL AND NOT held_out").collect()]
    used = {int(node) for i in {i for ids in texts for i in ids.tolist()} for node in tree.nodes[tree.starts[i]:tree.starts[i] + tree.sizes[i]]}
    assert used == {i - n_ids for i in changed.tolist() if n_ids <= i < 2 * n_ids - 1}


def test_training_learns_and_op11_equals_the_plain_base(spark, odd_docs, no_docs, monkeypatch):
    words = ["alpha", "beta", "gamma", "delta"]
    rows = [(1_000 + i, " ".join(words[(i + k) % 4] for k in range(60))) for i in range(400)]
    docs = odd_docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    args = "doc_id", "text", tokenizer_file("byte_bpe_50k.tiktoken"), tokenizer_pattern()
    got = lm.score_texts(docs, *args, rounds=2, share=2).collect()
    split = [(r["doc_id"], [*(r["text"] or "").encode().lower().split(), b""]) for r in docs.collect()]
    count = collections.Counter(w for i, ws in split for w in ws if i is None or zlib.crc32(str(i).encode()) % 10)
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), i is not None and zlib.crc32(str(i).encode()) % 10 == 0, len(ws), sum(count[w] > 0 for w in ws), n,
                   round(math.fsum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for i, ws in split)
    assert sorted((str(r["id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    untrained = {r["id"]: r["score"] for r in lm.score_texts(docs, *args, rounds=0).collect()}
    held = [r for r in got if r["held_out"] and (r["id"] or 0) >= 1_000]
    assert sum(r["score"] for r in held) > 0.8 * sum(untrained[r["id"]] for r in held)
    assert all(r["score"] < 0 for r in got)
    assert lm.score_texts(no_docs, *args).count() == 0
