"""Byte-level BPE by DuckDB recursive queries (operator 4).

Each task finds the pattern's matches of its texts and encodes the distinct ones: rows
(word, position, id) join the merge table, and a recursive query contracts each word's
leftmost pair of minimum rank until none is left.  Decoding joins ids with the
vocabulary, in order.  Spark partitions the texts; DuckDB runs
single-threaded in the worker's memory, a bounded slice of rows at a time.

Nulls and edges: a null text is an empty text and has no ids; a text or a match of any
length is encoded whole; rows are
independent, so ties and repeated rows need nothing; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import chunks
from .common import hold_cache, slices

BATCH_CHARS = 1_000_000
BATCH_POSITIONS = 100_000
BATCH_TOKENS = 100_000
CACHE_CHUNKS = 600_000
MEMORY = "256MB"

#: The recursion's table holds one row a position (numbered across the words), replaced at each contraction; a position that is merged away gets -1.
_ENCODE = """
WITH RECURSIVE step(word, pos, id) USING KEY (pos) AS (
  SELECT word, pos, id FROM state
  UNION ALL
  (WITH p AS MATERIALIZED (
     SELECT word, pos, id, lead(id) OVER w AS next_id, lead(pos) OVER w AS next_pos, lead(word) OVER w AS next_word
     FROM step WHERE id >= 0 WINDOW w AS (ORDER BY pos)),
   hit AS (
     SELECT p.word, min(m.merged * 4294967296 + p.pos) AS best, arg_min(p.next_pos, m.merged * 4294967296 + p.pos) AS gone
     FROM p JOIN merges m ON m.a = p.id AND m.b = p.next_id WHERE p.word = p.next_word GROUP BY p.word)
   SELECT p.word, p.pos, CASE WHEN p.pos = hit.best % 4294967296 THEN hit.best // 4294967296 WHEN p.pos = hit.gone THEN -1 ELSE p.id END
   FROM p JOIN hit ON p.word = hit.word)
)
SELECT word, id FROM step WHERE id >= 0 ORDER BY pos
"""

_DECODE = """
SELECT coalesce(v.raw, ''::BLOB) AS raw FROM tokens t LEFT JOIN vocabulary v ON v.id = t.id ORDER BY t.pos
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Bpe:
    """A worker's DuckDB connection, its merge table or vocabulary, made at the first use of each, and its cache of chunks."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex
        self.path, self.pattern = path, regex.compile(pattern)
        self.con = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": MEMORY, "temp_directory": ""})
        self.byte_ids: np.ndarray | None = None
        self.decodes = False
        self.encoder = chunks.ChunkEncoder(self._encode_chunks, "<u4", cache_chunks=CACHE_CHUNKS)

    def _ready_to_encode(self) -> None:
        if self.byte_ids is None:
            ranks = read_ranks(self.path)
            pairs = [(ranks[token[:i]], ranks[token[i:]], rank) for token, rank in ranks.items()
                     for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
            self._keep("merges", dict(zip(("a", "b", "merged"), np.array(pairs, np.int64).reshape(-1, 3).T)))
            self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def _ready_to_decode(self) -> None:
        if not self.decodes:
            ranks = read_ranks(self.path)
            self._keep("vocabulary", {"id": np.array(list(ranks.values()), np.int32), "raw": pa.array(list(ranks), pa.binary())})
            self.decodes = True

    def _keep(self, name: str, columns: dict) -> None:
        self._table("given", columns)
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def _table(self, name: str, columns: dict) -> None:
        self.con.register(name, pa.table(columns))

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word by the recursive query; the words of one call share it."""
        return [np.frombuffer(x, "<u4") for x in self._word_bytes(words)]

    def _word_bytes(self, words: list[str]) -> list[bytes]:
        self._ready_to_encode()
        raw = [w.encode("utf-8", "replace") for w in words]
        found = [b""] * len(raw)
        for lo, hi in slices([len(x) for x in raw], BATCH_POSITIONS):
            sizes = np.array([len(x) for x in raw[lo:hi]], np.int64)
            word = np.repeat(np.arange(hi - lo, dtype=np.int64), sizes)
            if not len(word):
                continue
            ids = self.byte_ids[np.frombuffer(b"".join(raw[lo:hi]), np.uint8)]
            self._table("state", {"word": word, "pos": np.arange(len(word), dtype=np.int64), "id": ids})
            out = self.con.execute(_ENCODE).fetchnumpy()
            blob, ends = out["id"].astype("<u4").tobytes(), np.cumsum(np.bincount(out["word"], minlength=hi - lo) * 4).tolist()
            found[lo:hi] = [blob[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        return found

    def _encode_chunks(self, parts: list[str]) -> list[bytes]:
        split = [self.pattern.findall(x) for x in parts]
        new = list({w for ws in split for w in ws})
        words = dict(zip(new, self._word_bytes(new)))
        return [b"".join([words[w] for w in ws]) if len(ws) != 1 else words[ws[0]] for ws in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.encoder.encode(texts)

    def decode(self, blobs: list[bytes]) -> list[bytes]:
        """The bytes of each row of ids (u32 little-endian): the vocabulary's bytes in the order of the ids."""
        self._ready_to_decode()
        ids = np.frombuffer(b"".join(blobs), "<u4").astype(np.int32)
        self._table("tokens", {"pos": np.arange(len(ids), dtype=np.int32), "id": ids})
        parts = self.con.execute(_DECODE).fetchnumpy()["raw"].tolist()
        ends = np.cumsum([len(b) // 4 for b in blobs]).tolist()
        return [b"".join(parts[a:b]) for a, b in zip([0, *ends[:-1]], ends)]


_WORKERS: dict[tuple[str, str], Bpe] = {}


def worker(path: str, pattern: str) -> Bpe:
    hold_cache("bpe", _WORKERS.clear)
    if (path, pattern) not in _WORKERS:
        _WORKERS[path, pattern] = Bpe(path, pattern)
    return _WORKERS[path, pattern]


def encode(text: Column, path: str, pattern: str) -> Column:
    """Ids of a text as little-endian u32 bytes."""

    @F.pandas_udf("binary")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = worker(path, pattern)
        for batch in batches:
            texts = ["" if t is None else t for t in batch]
            yield pd.Series([x for lo, hi in slices([len(t) for t in texts], BATCH_CHARS) for x in bpe.encode(texts[lo:hi])], dtype=object)

    return apply(text)


def decode(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that ids stand for (null: empty)."""

    @F.pandas_udf("binary")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = worker(path, pattern)
        for batch in batches:
            blobs = [b"" if b is None else bytes(b) for b in batch]
            yield pd.Series([x for lo, hi in slices([len(b) // 4 for b in blobs], BATCH_TOKENS) for x in bpe.decode(blobs[lo:hi])], dtype=object)

    return apply(ids)


def transcode(text: Column, path: str, pattern: str) -> Column:
    """struct(ids, decoded): ``encode`` and ``decode`` of its ids by one worker, which spares the memory of a second."""

    @F.pandas_udf("ids binary, decoded binary")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = worker(path, pattern)
        for batch in batches:
            texts = ["" if t is None else t for t in batch]
            ids = [x for lo, hi in slices([len(t) for t in texts], BATCH_CHARS) for x in bpe.encode(texts[lo:hi])]
            decoded = [x for lo, hi in slices([len(b) // 4 for b in ids], BATCH_TOKENS) for x in bpe.decode(ids[lo:hi])]
            yield pd.DataFrame({"ids": ids, "decoded": decoded}, dtype=object)

    return apply(text)
