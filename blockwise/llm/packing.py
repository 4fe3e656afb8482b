"""Sequence packing by non-negative least squares over a length histogram (operator 8).

Documents are encoded once and their ids stored in the shared folder.  A document's
full windows are sequences of their own; its remainder is rounded up to ``GRANULE``
tokens and counted in a histogram of at most window / granule bins, whatever the
corpus.  The driver enumerates combinations of up to three bins that fill a window
exactly, solves their repeat counts by non-negative least squares, rounds down, and
packs the residual histogram greedily, cutting an item where nothing else fits.  The
plan is a short list of (bin, rank range) rules, which Spark joins with the ranks of
the remainders; no list of documents reaches the driver or a single task.

Nulls and edges: a null text is an empty text and yields its end id alone; repeated
rows and ties are packed as separate documents; a text of any length is cut into
windows; an empty table gives no rows.  Only the id and text columns are read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from . import chunks
from .common import hold_cache, materialize, slices

WINDOW = 2048
GRANULE = 8
DEPTH = 3
BATCH_CHARS = 500_000
RULE_SCHEMA = pa.schema([("bin", pa.int32()), ("lo", pa.int64()), ("hi", pa.int64()), ("sequence0", pa.int64()), ("slot", pa.int32()),
                         ("cut_from", pa.int32()), ("cut_to", pa.int32())])


def nnls(a: np.ndarray, b: np.ndarray, steps: int = 600) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    for _ in range(steps):
        gradient = a.T @ (b - a @ x)
        gradient[active] = 0
        j = int(np.argmax(gradient)) if n else 0
        if n == 0 or gradient[j] <= 1e-9 * max(1.0, float(np.abs(b).max())):
            break
        active[j] = True
        while True:
            index = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, index], b, rcond=None)[0]
            if (z > 1e-12).all():
                x[:] = 0
                x[index] = z
                break
            low = z <= 1e-12
            now = x[index]
            step = float(np.min(now[low] / np.maximum(now[low] - z[low], 1e-300)))
            x[index] = now + step * (z - now)
            x[index[low & (x[index] <= 1e-9)]] = 0
            gone = active & (x <= 0)
            if not gone.any():
                gone[index[low][0]] = True
            active &= ~gone
            x[~active] = 0
            if not active.any():
                break
    return x


def combinations(bins: list[int], units: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Combinations of up to ``depth`` of the ``bins`` that sum to ``units`` exactly, largest first."""
    have, found = set(bins), []
    for d in range(1, depth + 1):
        for head in combinations_with_replacement(sorted(bins, reverse=True), d - 1):
            last = units - sum(head)
            if last in have and (not head or last <= head[-1]):
                found.append((*head, last))
    return found


def plan(histogram: dict[int, int], units: int, depth: int = DEPTH) -> tuple[list[tuple], int]:
    """Rules (bin, lo, hi, sequence0, slot, cut_from, cut_to) and the number of sequences.

    Items of ``bin`` ranked lo <= r < hi go to sequence sequence0 + r - lo at ``slot``;
    cut_from and cut_to are units within the item, cut_to null to its end.
    """
    stock = {b: deque([(b, 0, n, 0)]) for b, n in histogram.items() if n > 0}  # runs (bin, lo, hi, units used before)
    rules: list[tuple] = []
    sequences = 0
    combos = combinations(list(stock), units, depth)
    if combos:
        row = {b: i for i, b in enumerate(sorted(stock))}
        a = np.zeros((len(row), len(combos)))
        for j, combo in enumerate(combos):
            for b in combo:
                a[row[b], j] += 1
        counts = np.array([histogram[b] for b in sorted(stock)], float)
        repeats = nnls(a, counts / counts.max()) * counts.max()
        left = dict(histogram)
        for j in np.argsort(-repeats, kind="stable"):
            r = int(np.floor(repeats[j] + 1e-6))
            r = min([r, *(left[b] // combos[j].count(b) for b in combos[j])])
            if r <= 0:
                continue
            for slot, b in enumerate(combos[j]):
                _, lo, hi, _ = stock[b][0]
                rules.append((b, lo, lo + r, sequences, slot, 0, None))
                stock[b][0] = (b, lo + r, hi, 0)
                left[b] -= r
            sequences += r
        stock = {b: runs for b, runs in stock.items() if runs[0][1] < runs[0][2]}
    while stock:
        space, chosen = units, []  # (size, run, units taken)
        used: dict[int, int] = {}

        def free(b: int) -> bool:
            _, lo, hi, _ = stock[b][0]
            return hi - lo > used.get(b, 0)

        while space:
            fits = [b for b in stock if b <= space and free(b)]
            if fits:
                b = max(fits)
                chosen.append((b, b))
            else:
                longer = [b for b in stock if b > space and free(b)]
                if not longer:
                    break
                b = max(longer)
                chosen.append((b, space))
            used[b] = used.get(b, 0) + 1
            space -= chosen[-1][1]
        r = min((stock[b][0][2] - stock[b][0][1]) // n for b, n in used.items())
        rest = []
        for slot, (b, taken) in enumerate(chosen):
            source, lo, hi, before = stock[b][0]
            rules.append((source, lo, lo + r, sequences, slot, before, before + taken if taken < b else None))
            if taken < b:
                rest.append((b - taken, (source, lo, lo + r, before + taken)))
            stock[b][0] = (source, lo + r, hi, before)
        sequences += r
        for b in used:
            if stock[b][0][1] >= stock[b][0][2]:
                stock[b].popleft()
            if not stock[b]:
                del stock[b]
        for b, run in rest:
            stock.setdefault(b, deque()).append(run)
    return rules, sequences


def _record(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ([] for _ in schema)
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)


def encode_documents(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int,
                     window: int = WINDOW, granule: int = GRANULE, cache_chunks: int = chunks.CACHE_CHUNKS) -> DataFrame:
    """One row per document: its ids (zstd), its length, and its remainder's bin and rank within its partition."""
    dtype = chunks.vocabulary_dtype(tokenizer)

    schema = pa.schema([("part", pa.int32()), ("row", pa.int64()), ("id", pa.int64()), ("n_tokens", pa.int64()), ("n_full", pa.int64()),
                        ("full_rank", pa.int64()), ("bin", pa.int32()), ("rank", pa.int64()), ("ids", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, row, full = TaskContext.get().partitionId(), 0, 0
        ranks: dict[int, int] = {}
        encoder, end = chunks.tokenizers_encoder(tokenizer, dtype, cache_chunks), np.array([end_id], dtype).tobytes()
        press = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            keys, texts = batch.column("id"), batch.column("text")
            # no more of the batch than is encoded at a time becomes Python strings
            for lo, hi in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist(), BATCH_CHARS):
                out = []
                for key, raw in zip(keys[lo:hi].to_pylist(), encoder.encode([t or "" for t in texts[lo:hi].to_pylist()])):
                    raw += end
                    n = len(raw) // np.dtype(dtype).itemsize
                    n_full, rest = divmod(n, window)
                    size = -(-rest // granule)
                    out.append((part, row, key, n, n_full, full, size, ranks.get(size, 0), press(raw)))
                    full, row = full + n_full, row + 1
                    ranks[size] = ranks.get(size, 0) + 1
                yield _record(schema, out)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(encode, from_arrow_schema(schema))


def pack(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int,
         window: int = WINDOW, granule: int = GRANULE, depth: int = DEPTH, cache_chunks: int = chunks.CACHE_CHUNKS) -> DataFrame:
    """(id, start, length, doc_tokens, sequence_id, offset, ids): one row per piece; ids as little-endian u32 bytes.

    ``cache_chunks``: pieces of text that a worker keeps the ids of; fewer take less memory and more time."""
    spark = docs.sparkSession
    dtype = chunks.vocabulary_dtype(tokenizer)
    encoded = materialize(encode_documents(docs, id_col, text_col, tokenizer, end_id, window, granule, cache_chunks), "token-ids")
    meta = encoded.drop("ids")
    # counts of each bin before each partition; bin -1 stands for full windows
    counts = (meta.groupBy("part", "bin").agg(F.count("*").alias("n")).filter("bin > 0")
              .unionByName(meta.groupBy("part").agg(F.sum("n_full").alias("n")).select("part", F.lit(-1).alias("bin"), "n")))
    before = Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(counts.select("part", "bin", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "pack-bases")
    totals = {r["bin"]: r["n"] for r in bases.groupBy("bin").agg(F.sum("n").alias("n")).collect()}  # at most window / granule + 1 rows
    rules, sequences = plan({b: n for b, n in totals.items() if b > 0}, window // granule, depth)
    # bounded by the bins, not by the corpus; a list would go through Python workers of its own kind, which stay
    rules_df = F.broadcast(spark.createDataFrame(pa.Table.from_batches([_record(RULE_SCHEMA, rules)])))
    small = bases.filter("bin > 0").select("part", "bin", "base")
    rest = (meta.filter("bin > 0").select("part", "row", "bin", "rank", "n_tokens", "n_full").join(small, ["part", "bin"])
            .withColumn("item", F.col("rank") + F.col("base"))
            .join(rules_df.withColumnRenamed("bin", "rule_bin"), F.expr("bin = rule_bin AND item >= lo AND item < hi"))
            .withColumn("begin", F.col("cut_from") * granule)
            .withColumn("stop", F.coalesce(F.col("cut_to") * granule, F.col("n_tokens") - F.col("n_full") * window))
            .select("part", "row", (F.col("n_full") * window + F.col("begin")).alias("start"), (F.col("stop") - F.col("begin")).alias("length"),
                    (F.col("sequence0") + F.col("item") - F.col("lo")).alias("sequence_id"), "slot"))
    inside = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    rest = rest.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    pieces = rest.groupBy("part", "row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    full_base = bases.filter("bin = -1").select("part", F.col("base").alias("full_base"))
    joined = (encoded.join(full_base, "part", "left").join(pieces, ["part", "row"], "left")
              .select("id", "n_tokens", "n_full", (F.col("full_rank") + F.coalesce("full_base", F.lit(0)) + sequences).alias("full0"), "pieces", "ids"))

    schema = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                        ("offset", pa.int64()), ("ids", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_cache("packing", dict)
        unpress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for lo, hi in slices(batch.column("n_tokens").to_pylist(), BATCH_CHARS):
                out = []
                for key, n, n_full, full0, rest, blob in zip(*(c.to_pylist() for c in batch[lo:hi].columns)):
                    raw = np.frombuffer(unpress(blob), dtype).astype("<u4").tobytes()
                    for k in range(n_full):
                        out.append((key, k * window, window, n, full0 + k, 0, raw[4 * k * window:4 * (k + 1) * window]))
                    for p in rest if rest is not None else ():
                        a, size = p["start"], p["length"]
                        out.append((key, a, size, n, p["sequence_id"], p["offset"], raw[4 * a:4 * (a + size)]))
                yield _record(schema, out)

    return joined.mapInArrow(cut, from_arrow_schema(schema))
