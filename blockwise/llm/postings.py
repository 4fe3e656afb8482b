"""Inverted blocks: for every key, the documents of a block that hold it and how often.

A block is up to ``BLOCK_DOCS`` documents of one task, numbered from 0.  A posting is a
compressed bitmap of these numbers (a sorted u16 list, or a plain bitmap where that is
smaller) and multiplicity planes: bit k of every document's multiplicity less one, by the
document's place in the bitmap, for as many k as are needed (mostly none).  The bitmaps of a
key in different blocks cover different documents, so OR-merging them is putting them side by
side, and their popcounts add up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

DOC_BITS = 12
BLOCK_DOCS = 1 << DOC_BITS
BITMAP_BYTES = BLOCK_DOCS // 8
#: Incidences (a key in a document) after which a block is closed.
BLOCK_INCIDENCES = 2_000_000


def block_number(partition: int, nth: int) -> int:
    return (partition << 32) + nth


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``codes`` in order, with the sums of their ``counts``."""
    if not len(codes):
        return codes, counts
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[first], np.add.reduceat(counts[order], first)


def _planes(counts: np.ndarray) -> bytes:
    more = counts - 1
    bits = int(more.max()).bit_length()
    return b"".join(np.packbits((more >> k) & 1, bitorder="little").tobytes() for k in range(bits))


def postings(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes], list[bytes]]:
    """Keys, document counts, bitmaps and planes of ``codes`` (key << DOC_BITS | document, distinct and in order)."""
    keys, docs = codes >> DOC_BITS, (codes & (BLOCK_DOCS - 1)).astype("<u2")
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    ends = np.r_[first[1:], len(keys)]
    sizes = ends - first
    raw = docs.tobytes()
    bitmaps = [raw[2 * a:2 * b] for a, b in zip(first.tolist(), ends.tolist())]
    for i in np.flatnonzero(2 * sizes >= BITMAP_BYTES).tolist():
        bits = np.zeros(BLOCK_DOCS, np.uint8)
        bits[docs[first[i]:ends[i]]] = 1
        bitmaps[i] = np.packbits(bits, bitorder="little").tobytes()
    planes = [b""] * len(first)
    if len(first):
        for i in np.flatnonzero(np.maximum.reduceat(counts, first) > 1).tolist():
            planes[i] = _planes(counts[first[i]:ends[i]])
    return keys[first], sizes, bitmaps, planes


def incidences(n_docs: np.ndarray, bitmaps: pa.ChunkedArray, planes: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of postings: for every document of each, the posting's place, the document and its multiplicity."""
    place = np.repeat(np.arange(len(n_docs)), n_docs)
    docs, counts = np.empty(len(place), np.int64), np.ones(len(place), np.int64)
    begins = np.cumsum(n_docs) - n_docs
    raw = bitmaps.to_pylist()
    dense = 2 * n_docs >= BITMAP_BYTES
    docs[~dense[place]] = np.frombuffer(b"".join([x for x, d in zip(raw, dense.tolist()) if not d]), "<u2")
    for i in np.flatnonzero(dense).tolist():
        docs[begins[i]:begins[i] + n_docs[i]] = np.flatnonzero(np.unpackbits(np.frombuffer(raw[i], np.uint8), bitorder="little"))
    held = planes.to_pylist()
    for i in np.flatnonzero(pc.binary_length(planes).to_numpy()).tolist():
        n = int(n_docs[i])
        bits = np.unpackbits(np.frombuffer(held[i], np.uint8).reshape(-1, (n + 7) // 8), axis=1, count=n, bitorder="little")
        counts[begins[i]:begins[i] + n] += (bits.astype(np.int64) << np.arange(len(bits))[:, None]).sum(0)
    return place, docs, counts


def document_count(bitmap: Column) -> Column:
    """Popcount of a posting's bitmap."""
    size = F.octet_length(bitmap)
    return F.when(size == BITMAP_BYTES, F.bitmap_count(bitmap)).otherwise(F.floor(size / 2)).cast("long")


def occurrence_count(bitmap: str, planes: str) -> Column:
    """The sum of a posting's multiplicities: its popcount and the weighted popcounts of its planes."""
    n = f"(CASE WHEN octet_length({bitmap}) = {BITMAP_BYTES} THEN bitmap_count({bitmap}) ELSE octet_length({bitmap}) DIV 2 END)"
    size = f"CAST(({n} + 7) DIV 8 AS INT)"
    more = (f"aggregate(sequence(0, CAST(octet_length({planes}) DIV {size} AS INT) - 1), 0L, "
            f"(s, k) -> s + shiftleft(1L, k) * bitmap_count(substring({planes}, k * {size} + 1, {size})))")
    return F.expr(f"CAST({n} AS BIGINT) + CASE WHEN octet_length({planes}) = 0 THEN 0L ELSE {more} END")


class Block:
    """The open block of a task: documents are added with their keys, and it is closed when full."""

    def __init__(self, partition: int):
        self.partition, self.nth = partition, 0
        self.clear()

    def clear(self) -> None:
        self.docs, self.codes, self.counts, self.size = 0, [], [], 0

    @property
    def number(self) -> int:
        return block_number(self.partition, self.nth)

    def room(self) -> int:
        """How many documents may still be added."""
        return BLOCK_DOCS - self.docs if self.size < BLOCK_INCIDENCES else 0

    def add(self, n_docs: int, keys: np.ndarray, docs: np.ndarray, counts: np.ndarray) -> None:
        """``n_docs`` documents; ``docs`` numbers them from 0, ``keys`` are whole numbers."""
        codes, counts = summed(keys << DOC_BITS | (docs + self.docs), counts)
        self.codes.append(codes)
        self.counts.append(counts)
        self.docs += n_docs
        self.size += len(codes)

    def close(self) -> tuple[np.ndarray, np.ndarray]:
        """The block's codes (key << DOC_BITS | document) in order and their counts; the next block begins."""
        out = summed(np.concatenate([np.zeros(0, np.int64), *self.codes]), np.concatenate([np.zeros(0, np.int64), *self.counts]))
        self.nth += 1
        self.clear()
        return out


def record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch of ``schema``; columns that are not given are null."""
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def groups_of(sizes: list[int], chars: int, room) -> Iterator[tuple[int, int]]:
    """Ranges of documents of ``chars`` characters and ``room()`` documents at most (one document at least)."""
    start = 0
    while start < len(sizes):
        end, total, most = start, 0, max(1, room())
        while end < len(sizes) and end - start < most and (end == start or total + sizes[end] <= chars):
            total += sizes[end]
            end += 1
        yield start, end
        start = end
