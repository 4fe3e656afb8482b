"""Wavelet shards, BPE and packing against the tokenizer libraries and round trips."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockwise.llm import bpe, chunks, common, packing, wavelet
from blockwise.llm.common import hold_cache, tokenizer_file, tokenizer_pattern

from odd_rows import no_docs, odd_docs  # noqa: E402, F401


def library(name):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_file(name))
    tok.encode_special_tokens = True
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


def tiktoken_encode(text):
    import tiktoken
    ranks = bpe.read_ranks(tokenizer_file("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=tokenizer_pattern(), mergeable_ranks=ranks, special_tokens={}).encode_ordinary(text or "")


def noise(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choice(" abcdé.ß'\n\t12,  ABÄİ́<|endoftext|>") for _ in range(n))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_chunked_encoding_equals_the_library(name):
    encoder, ids = chunks.tokenizers_encoder(tokenizer_file(name), "<u2"), library(name)
    texts = [noise(i, 300) for i in range(60)] + [" lead", "trail ", "a  b", "a \nb", "it's 's end.", "é́ x", "<|endoftext|>"]
    for text, raw in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(raw, "<u2").tolist() == ids(text), repr(text)


def test_plain_text_is_cut_into_words_and_stops_that_are_encoded_once():
    assert chunks.split_pieces("One two.\nTwo, 3.5 ж!") == ["One", " two", ".", "\n", "Two", ",", " 3", ".5", " ж", "!"]
    for odd in ("a..", "a  b", "a .", " a", "a\n", "a\n\nb", "a\0b", "İ.", "é́.", "क़.", "a\n .b"):
        assert chunks.split_pieces(odd) == chunks.split_chunks(odd), odd
    seen = []

    def ids(pieces):
        seen.extend(pieces)
        return [[len(x)] for x in pieces]

    encoder = chunks.ChunkEncoder(ids, "<u2")
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(["a bc.\na bc, a", "x bc.", "x.."])] == [[1, 3, 1, 1, 1, 3, 1, 2], [1, 3, 1], [1, 2]]
    assert encoder.encode(["a bc!"]) and encoder.encode([]) == [] and sorted(seen) == sorted({*seen})


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_a_table_that_is_emptied_gives_the_same_ids(name):
    ids, path = library(name), tokenizer_file(name)
    rng = random.Random(7)
    words = ["Straße", "the", "ÉTÉ", "don't", "they're", "x2", "42", "жук", "ĳ", "ǅ", "İ", "one\ttwo", "(a)", "b*", "n's", "_", "e\u0301", "\u0958", "\u85e4"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", " ", ".", ", ", "\n", ".\n", "! ", "?", ";x", ": "]) for _ in range(40)) + "end." for _ in range(40)]
    hold_cache("another", lambda: None)
    encoder = chunks.tokenizers_encoder(path, "<u2", 30)
    for lo in range(0, len(texts), 7):
        for text, raw in zip(texts[lo:lo + 7], encoder.encode(texts[lo:lo + 7])):
            assert np.frombuffer(raw, "<u2").tolist() == ids(text), repr(text)
    hold_cache("another", lambda: None)


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    for n, top in ((1, 1), (200, 3), (1000, 40_000), (65, 65_536)):
        ids = rng.integers(0, top, n).astype(np.uint32)
        wm = wavelet.WaveletMatrix.build(ids, 16)
        assert wm.decode().tolist() == ids.tolist()
        for i in (0, n // 2, n - 1):
            token = int(ids[i])
            at = np.flatnonzero(ids == token).tolist()
            assert wm.access(i) == token and wm.count(token) == len(at)
            assert wm.occurrences(token) == at and wm.rank(token, i) == sum(x < i for x in at)
            with pytest.raises(IndexError):
                wm.select(token, len(at))
        assert wm.count(65_535 if top < 60_000 else 70_000) == 0


def test_token_file_round_trip(spark, odd_docs):
    ids = library("word_bpe_49k.json")
    shards = wavelet.token_file(odd_docs, "doc_id", "text", tokenizer_file("word_bpe_49k.json"), 2, shard_tokens=50).cache()
    got = wavelet.decode_documents(shards).orderBy("start").collect()
    keys = [r["id"] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k)) and len(got) == odd_docs.count()
    want = sorted(([*ids(r["text"]), 2] for r in odd_docs.collect()), key=lambda x: (len(x), x))
    assert sorted((np.frombuffer(r["ids"], "<u4").tolist() for r in got), key=lambda x: (len(x), x)) == want
    start = 0
    for r in got:
        assert (r["start"], r["n_tokens"]) == (start, len(r["ids"]) // 4)
        start += r["n_tokens"]
    stream = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in got])
    found = sorted(r["position"] for r in wavelet.find_token(shards, 2).collect())
    assert found == np.flatnonzero(stream == 2).tolist()


def test_bpe_equals_the_library_and_decodes(odd_docs):
    path, pattern = tokenizer_file("byte_bpe_50k.tiktoken"), tokenizer_pattern()
    ids = odd_docs.select("text", bpe.encode(F.col("text"), path, pattern).alias("ids"))
    for r in ids.select("*", bpe.decode(F.col("ids"), path, pattern).alias("back")).collect():
        text = r["text"] or ""
        assert np.frombuffer(r["ids"], "<u4").tolist() == tiktoken_encode(text)
        assert bytes(r["back"]) == text.encode()
    both = odd_docs.select("text", bpe.transcode(F.col("text"), path, pattern).alias("t")).select("text", "t.*")
    for r in both.collect():
        text = r["text"] or ""
        assert np.frombuffer(r["ids"], "<u4").tolist() == tiktoken_encode(text) and bytes(r["decoded"]) == text.encode()


def test_bpe_on_noise():
    worker = bpe.worker(tokenizer_file("byte_bpe_50k.tiktoken"), tokenizer_pattern())
    texts = [noise(i, 400) for i in range(30)] + ["ab" * 400]
    for text, raw in zip(texts, worker.encode(texts)):
        assert np.frombuffer(raw, "<u4").tolist() == tiktoken_encode(text)


def test_bpe_decodes_rows_of_any_ids():
    worker = bpe.worker(tokenizer_file("byte_bpe_50k.tiktoken"), tokenizer_pattern())
    a, b, none = worker.encode(["a word", "words of another", ""])
    unknown = np.array([2 ** 31 - 1], "<u4").tobytes()
    assert worker.decode([none, a, unknown, b, a + unknown + b]) == [b"", b"a word", b"", b"words of another", b"a wordwords of another"]
    assert all(isinstance(x, bytes) for x in worker._encode_chunks([" word", "", " two words"]))


def test_words_are_normalised_and_tokenized_together():
    class Counting:
        def __init__(self, tok):
            self.tok, self.model, self.normalizer, self.calls = tok, tok.model, self, 0

        def normalize_str(self, text):
            self.calls += 1
            return self.tok.normalizer.normalize_str(text)

        def encode(self, *args, **kw):
            return self.tok.encode(*args, **kw)

    from tokenizers import Tokenizer
    tok = Counting(Tokenizer.from_file(tokenizer_file("word_bpe_49k.json")))
    words = [" Straße", "Straße", " ÉTÉ", "the", " The", "x"]
    encode = chunks._word_encoder(tok)
    tok.calls = 0
    assert encode(words) == [tok.encode(w, add_special_tokens=False).ids for w in words] and tok.calls == 1
    assert encode([]) == []


def test_a_worker_holds_the_cache_of_one_operator():
    encoder = chunks.tokenizers_encoder(tokenizer_file("byte_bpe_50k.json"), "<u2")
    encoder.encode(["some words"])
    assert chunks.tokenizers_encoder(tokenizer_file("byte_bpe_50k.json"), "<u2") is encoder
    left = []
    hold_cache("another", lambda: left.append(1))
    assert not chunks._ENCODERS
    chunks.tokenizers_encoder(tokenizer_file("byte_bpe_50k.json"), "<u2")
    assert left == [1]


def test_nnls_and_plan():
    rng = np.random.default_rng(2)
    a, x = rng.random((20, 8)), np.array([0, 1, 0, 2, 0, 0, 3, 0.5])
    assert np.allclose(packing.nnls(a, a @ x), x, atol=1e-6)
    assert (packing.nnls(a, -np.ones(20)) == 0).all()
    for histogram in ({3: 7}, {200: 50, 190: 41}, {b: int(n) for b, n in zip(range(1, 257), rng.integers(0, 50, 256))}, {}):
        rules, sequences = packing.plan(histogram, 256)
        room, covered = {}, {}
        for b, lo, hi, first, slot, begin, end in rules:
            for r in range(lo, hi):
                covered.setdefault((b, r), []).append((begin, end or b))
                room[first + r - lo] = room.get(first + r - lo, 0) + (end or b) - begin
        assert set(covered) == {(b, r) for b, n in histogram.items() for r in range(n)}
        for (b, _), parts in covered.items():
            parts.sort()
            assert [p[0] for p in parts] == [0, *[p[1] for p in parts[:-1]]] and parts[-1][1] == b
        assert all(v <= 256 for v in room.values()) and set(room) == set(range(sequences))
        assert sequences <= sum(b * n for b, n in histogram.items()) / 256 + 8


def test_packing(odd_docs):
    ids = library("byte_bpe_50k.json")
    rows = packing.pack(odd_docs, "doc_id", "text", tokenizer_file("byte_bpe_50k.json"), 1).toPandas()
    total = sum(len(ids(r["text"])) + 1 for r in odd_docs.collect())
    assert rows["length"].sum() == total
    for _, piece in rows.groupby("sequence_id"):
        piece = piece.sort_values("offset")
        assert piece["offset"].tolist() == [0, *piece["length"].cumsum().tolist()[:-1]] and piece["length"].sum() <= 2048
    long = rows[rows["id"] == 6].sort_values("start")
    stream = np.frombuffer(b"".join(long["ids"]), "<u4").tolist()
    assert stream == [*ids("word " * 6_000), 1] and (long["doc_tokens"] == len(stream)).all()


def test_empty_tables(no_docs):
    word, byte = tokenizer_file("word_bpe_49k.json"), tokenizer_file("byte_bpe_50k.json")
    assert wavelet.decode_documents(wavelet.token_file(no_docs, "doc_id", "text", word, 2)).count() == 0
    assert packing.pack(no_docs, "doc_id", "text", byte, 1).count() == 0


def test_handed_on_worker_gives_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "release_memory", lambda: calls.append(1), raising=False)
    hold_cache("one", dict)
    calls.clear()
    hold_cache("one", dict)
    assert not calls
    hold_cache("another", dict)
    assert calls == [1]


def test_full_table_gives_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(chunks, "release_memory", lambda: calls.append(1), raising=False)
    encoder = chunks.ChunkEncoder(lambda pieces: [[len(p)] for p in pieces], "<u2", cache_chunks=2)
    first = encoder.encode(["a bb ccc dddd"])
    assert not calls
    assert encoder.encode(["a bb ccc dddd"]) == first and calls == [1]


def test_learning_does_not_walk_what_is_known():
    class Numbers(type(chunks.ChunkEncoder(None, "<u2").number)):
        def __iter__(self):
            raise AssertionError("walked")

    encoder = chunks.ChunkEncoder(lambda pieces: [[len(p)] for p in pieces], "<u2", lambda words: [[len(w), 0] for w in words])
    encoder.number = Numbers()
    encoder.number.default_factory = encoder.number.__len__
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(["a bé c1", "c1 bé a  "])] == [[1, 0, 3, 0, 3], [2, 3, 0, 4]]
