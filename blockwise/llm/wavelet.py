"""Token-ID output as one wavelet matrix per shard (operator 2).

A shard holds the ids of consecutive documents as ``levels`` bit-planes, most
significant bit first; at each level the ids are stably parted by that bit.
The planes, document lengths and zero counts are one zstd-compressed blob, and
rank and select over the planes answer token access, counting and occurrence
lookup without decoding the shard.

Nulls and edges: a null text is an empty text (its ids are the end id alone);
rows are ordered by id (null first), then by a hash of the text, so ties and
repeated rows keep a defined order; an empty table writes no shard.  Columns
other than id and text are left out of the file, so their names cannot clash.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import chunks
from .common import hold_cache, new_path, slices

MAGIC = b"WMX1"
SHARD_TOKENS = 1 << 18
BATCH_CHARS = 1_000_000
CACHE_CHUNKS = 900_000
SHARD_SCHEMA = "part int, shard int, n_docs int, n_tokens long, blob binary"


class WaveletMatrix:
    """Bit-planes of a sequence of ids with rank and select directories."""

    def __init__(self, n: int, planes: list[np.ndarray]):
        self.n, self.levels, self.planes = n, len(planes), planes
        self._ones = [np.concatenate(([0], np.cumsum(np.bitwise_count(p.view("<u8")), dtype=np.int64))) for p in planes]
        self.zeros = [n - int(o[-1]) for o in self._ones]

    @classmethod
    def build(cls, ids: np.ndarray, levels: int) -> WaveletMatrix:
        planes, a = [], ids
        for level in range(levels - 1, -1, -1):
            bits = (a & a.dtype.type(1 << level)) != 0
            packed = np.packbits(bits, bitorder="little")
            planes.append(np.concatenate((packed, np.zeros(-len(packed) % 8, np.uint8))))
            a = np.concatenate((np.compress(~bits, a), np.compress(bits, a)))  # indexing by a mask is slower
        return cls(len(ids), planes)

    def _bits(self, level: int) -> np.ndarray:
        return np.unpackbits(self.planes[level], bitorder="little", count=self.n).astype(bool)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (i & 7) & 1

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a level."""
        word, rest = i >> 6, i & 63
        n = int(self._ones[level][word])
        if rest:
            n += (int(self.planes[level].view("<u8")[word]) & ((1 << rest) - 1)).bit_count()
        return n

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.levels):
            bit, ones = self._bit(level, i), self._rank1(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the copies of ``token`` among the first ``end`` ids stand after the last level."""
        lo, hi = 0, end
        for level in range(self.levels):
            a, b = self._rank1(level, lo), self._rank1(level, hi)
            if token >> (self.levels - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, token: int, end: int) -> int:
        """Copies of ``token`` among the first ``end`` ids."""
        if token >> self.levels:
            return 0
        lo, hi = self._range(token, end)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """Position of the ``k``-th (from 0) copy of ``bit`` at a level."""
        ones = self._ones[level]
        before = ones if bit else np.arange(len(ones), dtype=np.int64) * 64 - ones
        word = int(np.searchsorted(before, k, side="right")) - 1
        value, k = int(self.planes[level].view("<u8")[word]), k - int(before[word])
        for i in range(64):
            if value >> i & 1 == bit:
                if k == 0:
                    return word * 64 + i
                k -= 1
        raise IndexError(k)

    def select(self, token: int, k: int) -> int:
        """Position of the ``k``-th (from 0) copy of ``token``; IndexError beyond the last."""
        lo, hi = self._range(token, self.n) if not token >> self.levels else (0, 0)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for level in range(self.levels - 1, -1, -1):
            bit = token >> (self.levels - 1 - level) & 1
            i = self._select_bit(level, bit, i - self.zeros[level] if bit else i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """All ids: the parting of each level undone from the last plane to the first."""
        a = np.zeros(self.n, np.uint32)
        for level in range(self.levels - 1, -1, -1):
            bits, up = self._bits(level), np.empty(self.n, np.uint32)
            up[np.flatnonzero(~bits)] = a[: self.zeros[level]]
            up[np.flatnonzero(bits)] = a[self.zeros[level]:] | np.uint32(1 << (self.levels - 1 - level))
            a = up
        return a


def pack_shard(keys: list, ids: list[np.ndarray], levels: int) -> bytes:
    """One file: header, zstd frame of document keys, lengths and planes."""
    flat = np.concatenate(ids)
    wm = WaveletMatrix.build(flat, levels)
    known = np.array([k is not None for k in keys], np.uint8)
    body = b"".join([known.tobytes(), np.array([k or 0 for k in keys], "<i8").tobytes(),
                     np.array([len(x) for x in ids], "<u4").tobytes(), *[p.tobytes() for p in wm.planes]])
    return MAGIC + struct.pack("<HIQ", levels, len(keys), len(flat)) + zstandard.ZstdCompressor(level=1).compress(body)


def open_shard(blob: bytes) -> tuple[list, np.ndarray, WaveletMatrix]:
    """Document keys, document lengths and the wavelet matrix of a shard file."""
    if blob[:4] != MAGIC:
        raise ValueError("not a wavelet shard")
    levels, n_docs, n = struct.unpack_from("<HIQ", blob, 4)
    body = zstandard.ZstdDecompressor().decompress(blob[18:])
    known = np.frombuffer(body, np.uint8, n_docs)
    keys = np.frombuffer(body, "<i8", n_docs, n_docs)
    lengths = np.frombuffer(body, "<u4", n_docs, 9 * n_docs)
    stride = (n + 63) // 64 * 8
    planes = [np.frombuffer(body, np.uint8, stride, 13 * n_docs + k * stride).copy() for k in range(levels)]
    return [int(k) if ok else None for k, ok in zip(keys, known)], lengths, WaveletMatrix(n, planes)


def write_shards(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, path: str,
                 shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``text_col`` and write shard files at ``path`` in ascending ``id_col`` order.

    One range shuffle puts the documents in order; each task then streams its range,
    closing a shard at ``shard_tokens`` ids, so no task holds more than a shard.
    """
    from tokenizers import Tokenizer
    levels = max(1, int(max(Tokenizer.from_file(tokenizer).get_vocab_size() - 1, end_id)).bit_length())
    dtype = "<u2" if levels <= 16 else "<u4"

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        part, shard, total = TaskContext.get().partitionId(), 0, 0
        encoder, end = chunks.tokenizers_encoder(tokenizer, dtype, CACHE_CHUNKS), np.array([end_id], dtype).tobytes()
        keys: list = []
        ids: list[np.ndarray] = []

        def flush() -> pd.DataFrame:
            return pd.DataFrame({"part": [part], "shard": [shard], "n_docs": [len(keys)], "n_tokens": [total], "blob": [pack_shard(keys, ids, levels)]})

        for batch in batches:
            texts = ["" if t is None else t for t in batch["text"]]
            known = [None if pd.isna(k) else int(k) for k in batch["id"]]
            for lo, hi in slices([len(t) for t in texts], BATCH_CHARS):
                for key, raw in zip(known[lo:hi], encoder.encode(texts[lo:hi])):
                    a = np.frombuffer(raw + end, dtype)
                    keys.append(key)
                    ids.append(a)
                    total += len(a)
                    if total >= shard_tokens:
                        yield flush()
                        keys, ids, total, shard = [], [], 0, shard + 1
        if keys:
            yield flush()

    ordered = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
               .repartitionByRange(F.col("id"), F.xxhash64("text"))
               .sortWithinPartitions("id", F.xxhash64("text")))
    ordered.mapInPandas(encode, SHARD_SCHEMA).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shard rows with ``start``: the ids in all shards before it."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    parts = (shards.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
             .withColumn("base", F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
             .select("part", F.coalesce("base", F.lit(0)).alias("base")))
    before = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = (shards.select("part", "shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("inner"))
              .join(parts, "part").select("part", "shard", (F.col("base") + F.col("inner")).alias("start")))
    return shards.join(starts, ["part", "shard"])


def decode_documents(shards: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids): every document of the shard files; ids as little-endian u32 bytes."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold_cache("wavelet", dict)
        for batch in batches:
            for blob, start in zip(batch["blob"], batch["start"]):
                keys, lengths, wm = open_shard(blob)
                raw, ends = wm.decode().astype("<u4").tobytes(), np.cumsum(lengths, dtype=np.int64)
                begins = ends - lengths
                yield pd.DataFrame({"id": pd.array(keys, "Int64"), "start": begins + int(start), "n_tokens": lengths.astype(np.int64),
                                    "ids": [raw[4 * a:4 * b] for a, b in zip(begins.tolist(), ends.tolist())]})

    return shards.select("blob", "start").mapInPandas(decode, "id long, start long, n_tokens long, ids binary")


def find_token(shards: DataFrame, token: int) -> DataFrame:
    """(position, offset in the whole token stream) of every occurrence of ``token``, from the planes alone."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for blob, start in zip(batch["blob"], batch["start"]):
                at = open_shard(blob)[2].occurrences(token)
                yield pd.DataFrame({"position": np.array(at, np.int64) + int(start)})

    return shards.select("blob", "start").mapInPandas(find, "position long")


def token_file(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int,
               shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shard files to the shared folder and return the shards read back."""
    path = new_path(docs.sparkSession, "wavelet")
    write_shards(docs, id_col, text_col, tokenizer, end_id, path, shard_tokens)
    return read_shards(docs.sparkSession, path)
