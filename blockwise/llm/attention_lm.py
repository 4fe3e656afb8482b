"""Scoring of texts by a causal self-attention model trained in numpy on subword ids (operator 11).

Text: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``; the public byte-level BPE makes subword ids
of each with a space before it, and an end id follows the last.  The model has one attention layer and one
hidden layer over windows of ids; its output is a Huffman tree over the whole vocabulary, so
every text has a probability.  The tree and the biases of its nodes come from the counts of
all training ids; the weights are trained by data-parallel rounds: every task starts from the
same weights, takes its training windows of the round in small steps, and Spark averages the
rows of the weight table that the tasks changed, each by how often it was used.  Every training
window is trained on, in one round: a hash deals the windows of all training texts to the
rounds.  Scoring reads each text in overlapping windows: a window's first ids
are context that the window before has scored, so each id is scored once.

Beside it stands the unigram base of the training words: counts by word over all training
texts, joined back through inverted blocks of documents, so neither the vocabulary nor
a frequent word meets in one task.

Nulls and edges: a null text is an empty text, which is the end alone; a null id is never held
out; long texts are taken whole; every row is a document of its own, also rows of the same id;
an empty table gives no rows; without training texts the counts are 0 and the tree is even;
other columns are not read.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

from .alignment import ragged
from .bpe import read_ranks
from .common import materialize
from .postings import DOC_BITS, Block, groups_of, record

#: Ids of a window, and how far the next window begins after it.
WINDOW, STRIDE = 32, 24
DIMS, HIDDEN = 8, 16
#: Rounds of training; a hash deals all training windows to them.
ROUNDS = 3
RATE = 0.1
#: Windows of a training step, and of a batch that is scored.
STEP_WINDOWS, SCORE_WINDOWS = 192, 512
BATCH_CHARS = 2_000_000
BATCH_IDS = 400_000
#: Added to every count, of words and of subword ids.
SMOOTHING = 0.1


# -- the output tree ----------------------------------------------------------

class Tree(NamedTuple):
    """For every id its nodes from the leaf up (in ``nodes`` from ``starts``, ``sizes`` of them), the
    side taken at each (1 or -1), and each node's log odds of side 1."""

    starts: np.ndarray
    sizes: np.ndarray
    nodes: np.ndarray
    sides: np.ndarray
    bias: np.ndarray


def huffman(counts: np.ndarray) -> Tree:
    """The Huffman tree of smoothed counts (two ids at least)."""
    weights = [float(c) + SMOOTHING for c in counts]
    n = len(weights)
    heap = [(w, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    parent, side, bias = np.full(2 * n - 1, -1, np.int64), np.zeros(2 * n - 1, np.int8), np.zeros(n - 1, np.float32)
    for node in range(n, 2 * n - 1):
        (wa, a), (wb, b) = heapq.heappop(heap), heapq.heappop(heap)
        parent[a] = parent[b] = node
        side[a], side[b] = 1, -1
        bias[node - n] = np.log(wa / wb)
        heapq.heappush(heap, (wa + wb, node))
    at, leaf, nodes, sides = np.arange(n), [], [], []
    who = np.arange(n)
    while len(at):
        up = parent[at]
        inner = up >= 0
        leaf.append(who[inner])
        nodes.append(up[inner] - n)
        sides.append(side[at[inner]])
        who, at = who[inner], up[inner]
    leaf, nodes, sides = map(np.concatenate, (leaf, nodes, sides))
    order = np.argsort(leaf, kind="stable")
    sizes = np.bincount(leaf, minlength=n)
    return Tree(np.cumsum(sizes) - sizes, sizes, nodes[order].astype(np.int32), sides[order].astype(np.float32), bias)


# -- the network --------------------------------------------------------------

class Parts(NamedTuple):
    """Views of the weight table, whose rows are ``DIMS`` wide."""

    embed: np.ndarray
    nodes: np.ndarray
    places: np.ndarray
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    out: np.ndarray
    widen: np.ndarray
    narrow: np.ndarray


def part_rows(n_ids: int) -> list[int]:
    return [n_ids, n_ids - 1, WINDOW, DIMS, DIMS, DIMS, DIMS, HIDDEN, HIDDEN]


def parts(table: np.ndarray, n_ids: int) -> Parts:
    return Parts(*np.split(table, np.cumsum(part_rows(n_ids))[:-1]))


def initial_weights(n_ids: int, seed: int = 0) -> np.ndarray:
    """Small random weights; node weights of 0, so that the model begins as the unigram of the tree."""
    table = np.random.default_rng(seed).normal(0, 0.25, (sum(part_rows(n_ids)), DIMS)).astype(np.float32)
    parts(table, n_ids).nodes[:] = 0
    return table


_CAUSAL = np.tril(np.ones((WINDOW, WINDOW), np.float32))
_SCALE = np.float32(DIMS ** -0.5)


def flat(t: np.ndarray) -> np.ndarray:
    return t.reshape(-1, t.shape[-1])


def forward(w: Parts, inputs: np.ndarray) -> tuple:
    """States of a batch of windows of ids (a row for each id), and what ``backward`` needs."""
    shape = (*inputs.shape, DIMS)
    x = np.take(w.embed, inputs.ravel(), 0).reshape(shape)
    x += w.places
    x = flat(x)
    q, k, v = ((x @ t).reshape(shape) for t in (w.query * _SCALE, w.key, w.value))
    a = q @ k.transpose(0, 2, 1)
    np.clip(a, -30, 30, out=a)
    np.exp(a, out=a)
    a *= _CAUSAL
    total = a.sum(2, keepdims=True)
    c = a @ v
    c /= total
    c = flat(c)
    h = x + c @ w.out
    r = h @ w.widen.T
    np.maximum(r, 0, out=r)
    return h + r @ w.narrow, (x, q, k, v, a, total, c, h, r)


def path_scores(tree: Tree, nodes: np.ndarray, states: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Natural log probability of each target after its state; and, for each node visited, the node, the
    visitor, the side taken, its log odds, and the states and node weights that met."""
    sizes = np.take(tree.sizes, targets)
    at = ragged(np.take(tree.starts, targets), sizes)
    node, side, who = np.take(tree.nodes, at), np.take(tree.sides, at), np.repeat(np.arange(len(targets)), sizes)
    state, weight = np.take(states, who, 0), np.take(nodes, node, 0)
    z = np.einsum("ij,ij->i", state, weight)
    z += np.take(tree.bias, node)
    z *= side
    losses = np.log(1 + np.exp(np.maximum(-z, -80)))
    return -np.add.reduceat(losses, np.cumsum(sizes) - sizes), (node, who, side, z, state, weight)


def row_sums(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the ``values`` (a row each) by their number below ``n``."""
    columns = np.ascontiguousarray(values.T, np.float64)
    return np.stack([np.bincount(rows, weights=c, minlength=n) for c in columns]).T


def run_sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of the ``values`` (a row each) over runs of so many rows."""
    columns = np.ascontiguousarray(values.T)
    return np.add.reduceat(columns, np.cumsum(sizes) - sizes, axis=1).T


class Step(NamedTuple):
    """What a batch asks of the weights: its log probability, and by row of the table the gradient and the uses."""

    log_probability: float
    rows: np.ndarray
    gradient: np.ndarray
    uses: np.ndarray


def used_rows(ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``ids`` below ``n`` in order, how often each stands, and the place of each id among them."""
    uses = np.bincount(ids, minlength=n)
    rows = np.flatnonzero(uses)
    place = np.empty(n, np.int64)
    place[rows] = np.arange(len(rows))
    return rows, uses[rows], np.take(place, ids)


def gradients(tree: Tree, table: np.ndarray, inputs: np.ndarray, targets: np.ndarray, scored: np.ndarray) -> Step:
    """The step of the ``scored`` targets of a batch of windows."""
    n_ids = len(tree.sizes)
    w = parts(table, n_ids)
    states, (x, q, k, v, a, total, c, h, r) = forward(w, inputs)
    mark = scored.ravel()
    logs, (node, who, side, z, state, weight) = path_scores(tree, w.nodes, states[mark], targets.ravel()[mark])
    odds = (side / (1 + np.exp(np.clip(z, -60, 60))))[:, None]
    node_rows, node_uses, node_place = used_rows(node, n_ids - 1)
    d_nodes = row_sums(node_place, odds * state, len(node_rows))
    d = np.zeros_like(states)
    d[mark] = run_sums(odds * weight, np.take(tree.sizes, targets.ravel()[mark]))

    shape = (*inputs.shape, DIMS)
    dr = (d @ w.narrow.T) * (r > 0)
    dh = d + dr @ w.widen
    a = a / total
    dc = (dh @ w.out.T).reshape(shape)
    da = dc @ v.transpose(0, 2, 1)
    dv = a.transpose(0, 2, 1) @ dc
    ds = a * (da - (da * a).sum(2, keepdims=True))
    dq, dk, dv = flat(ds @ k) * _SCALE, flat(ds.transpose(0, 2, 1) @ q), flat(dv)
    dx = dh + dq @ w.query.T + dk @ w.key.T + dv @ w.value.T
    embed_rows, embed_uses, embed_place = used_rows(inputs.ravel(), n_ids)
    dense = [dx.reshape(shape).sum(0), x.T @ dq, x.T @ dk, x.T @ dv, c.T @ dh, dr.T @ h, r.T @ d]
    first = 2 * n_ids - 1
    grad = np.concatenate([row_sums(embed_place, dx, len(embed_rows)), d_nodes, *dense])
    rows = np.concatenate([embed_rows, n_ids + node_rows, np.arange(first, len(table))])
    return Step(float(logs.sum()), rows, grad, np.concatenate([embed_uses, node_uses, np.full(len(table) - first, len(logs))]))


# -- windows ------------------------------------------------------------------

def windows(sizes: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over texts of ``sizes`` ids laid one after another: each one's text, its place there and
    the places it scores first (0 in a text's first window, else those that overlap are context)."""
    count = 1 + np.maximum(0, -(-(sizes - WINDOW) // stride))
    text = np.repeat(np.arange(len(sizes)), count)
    place = ragged(np.zeros(len(sizes), np.int64), count) * stride
    return text, place, np.where(place > 0, WINDOW - stride, 0)


class Stream(NamedTuple):
    """Texts as one array of ids and one of the ids before them (the end id before the first)."""

    sizes: np.ndarray
    begins: np.ndarray
    ids: np.ndarray
    before: np.ndarray

    @staticmethod
    def of(blobs: list[bytes], end: int) -> Stream:
        sizes = np.array([len(b) // 2 for b in blobs], np.int64)
        ids = np.frombuffer(b"".join(blobs), "<u2").astype(np.int64)
        begins = np.cumsum(sizes) - sizes
        before = np.r_[end, ids[:-1]]
        before[begins] = end
        return Stream(sizes, begins, ids, before)

    def batch(self, text: np.ndarray, place: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs and targets of windows, and which targets they score."""
        inside = place[:, None] + np.arange(WINDOW)
        at = np.minimum(self.begins[text][:, None] + inside, len(self.ids) - 1)
        return self.before[at], self.ids[at], (inside < self.sizes[text][:, None]) & (np.arange(WINDOW) >= first[:, None])


def score_stream(tree: Tree, table: np.ndarray, stream: Stream) -> np.ndarray:
    """Natural log probability of each text."""
    w = parts(table, len(tree.sizes))
    total = np.zeros(len(stream.sizes))
    text, place, first = windows(stream.sizes, STRIDE)
    for lo in range(0, len(text), SCORE_WINDOWS):
        own = text[lo:lo + SCORE_WINDOWS]
        inputs, targets, scored = stream.batch(own, place[lo:lo + SCORE_WINDOWS], first[lo:lo + SCORE_WINDOWS])
        mark = scored.ravel()
        logs = path_scores(tree, w.nodes, forward(w, inputs)[0][mark], targets.ravel()[mark])[0]
        total += np.bincount(np.repeat(own, scored.sum(1)), weights=logs, minlength=len(total))
    return total


class Trainer:
    """A task's own copy of the weights, changed by steps of Adagrad."""

    def __init__(self, tree: Tree, table: np.ndarray):
        self.tree, self.start, self.table = tree, table, table.copy()
        self.squares, self.uses = np.full_like(table, 1e-6), np.zeros(len(table))

    def step(self, inputs: np.ndarray, targets: np.ndarray, scored: np.ndarray) -> float:
        found = gradients(self.tree, self.table, inputs, targets, scored)
        grad = (found.gradient / max(1, int(scored.sum()))).astype(np.float32)
        squares = self.squares[found.rows] + grad * grad
        self.squares[found.rows] = squares
        self.table[found.rows] += RATE * grad / np.sqrt(squares)
        self.uses[found.rows] += found.uses
        return found.log_probability

    def changes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows that were used, their uses and by how much they changed."""
        rows = np.flatnonzero(self.uses)
        return rows, self.uses[rows], self.table[rows] - self.start[rows]


# -- over a corpus ------------------------------------------------------------

_ENCODINGS: dict[tuple[str, str], object] = {}


def _encoding(path: str, pattern: str):
    if (path, pattern) not in _ENCODINGS:
        import tiktoken
        _ENCODINGS[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
    return _ENCODINGS[path, pattern]


class Words:
    """The distinct words of a block, numbered in order, and the ids of each; the word '' is the end."""

    def __init__(self, encode, end: int):
        self.encode, self.end = encode, end
        self.clear()

    def clear(self) -> None:
        self.number: defaultdict = defaultdict()
        self.number.default_factory = self.number.__len__
        self.sizes, self.starts, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u2")

    def numbers(self, split: list[list[bytes]]) -> np.ndarray:
        """The number of each word, one text after another; new words are encoded."""
        get = self.number.__getitem__
        keys = np.fromiter((k for words in split for k in map(get, words)), np.int64)
        new = [self.encode(" " + w.decode()) if w else [self.end] for w in islice(self.number, len(self.sizes), None)]
        if new:
            self.ids = np.concatenate([self.ids, np.concatenate(new).astype("<u2")])
            self.sizes = np.r_[self.sizes, [len(x) for x in new]]
            self.starts = np.cumsum(self.sizes) - self.sizes
        return keys

    def encoded(self, keys: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """The ids of texts of so many words each, as little-endian u16."""
        sizes = self.sizes[keys]
        raw = self.ids[ragged(self.starts[keys], sizes)].tobytes()
        ends = 2 * np.r_[0, np.cumsum(sizes)][np.cumsum(lengths)]
        return [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def held_out(id_: Column) -> Column:
    """Whether a document is kept from training."""
    return F.coalesce(F.crc32(id_.cast("string")) % 10 == 0, F.lit(False))


def read_corpus(docs: DataFrame, id_col: str, text_col: str, path: str, pattern: str, end: int) -> DataFrame:
    """Encode and invert every text, in blocks, to a table in the shared folder.

    Three kinds of rows: documents (block, doc, id, held_out, n_tokens, ids as little-endian u16);
    one with the postings of each block (block, lists: see ``pack_lists``); and the words of a block
    (block, place: that of the word's posting in the lists, word, trained: its occurrences in training
    documents).  The end is the word ''.
    """
    source = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    whole = pa.int64()
    schema = pa.schema([("block", whole), ("doc", pa.int32()), ("id", to_arrow_type(source.schema["id"].dataType)), ("held_out", pa.bool_()),
                        ("n_tokens", whole), ("ids", pa.binary()),
                        ("lists", pa.binary()), ("word", pa.string()), ("place", pa.int32()), ("trained", whole)])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encode, block = _encoding(path, pattern).encode_ordinary, Block(TaskContext.get().partitionId())
        known = Words(encode, end)
        training: list[bool] = []

        def closed() -> Iterator[pa.RecordBatch]:
            at = block.number
            codes, counts = block.close()
            words, docs = list(known.number), codes & ((1 << DOC_BITS) - 1)
            first = np.flatnonzero(np.r_[True, np.diff(codes >> DOC_BITS) != 0])
            trained = np.add.reduceat(counts * np.array(training)[docs], first)
            known.clear()
            training.clear()
            yield record(schema, block=[at], lists=[pack_lists(np.diff(first, append=len(codes)), docs, counts)])
            yield record(schema, word=[words[k].decode() for k in (codes[first] >> DOC_BITS).tolist()], place=np.arange(len(first)),
                         block=np.full(len(first), at), trained=trained)

        for batch in batches:
            ids, out = batch.column("id"), batch.column("held_out")
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for lo, hi in groups_of([len(t) for t in texts], BATCH_CHARS, block.room):
                split = [[*t.encode("utf-8", "replace").lower().split(), b""] for t in texts[lo:hi]]
                sizes = np.array([len(words) for words in split], np.int64)
                keys = known.numbers(split)
                blobs = known.encoded(keys, sizes)
                training.extend(not x for x in out[lo:hi].to_pylist())
                yield record(schema, id=ids[lo:hi], held_out=out[lo:hi], ids=blobs, n_tokens=sizes,
                             block=np.full(hi - lo, block.number), doc=np.arange(block.docs, block.docs + hi - lo))
                block.add(hi - lo, keys, np.repeat(np.arange(hi - lo), sizes), np.ones(len(keys), np.int64))
                if not block.room():
                    yield from closed()
        if block.docs:
            yield from closed()

    return materialize(source.mapInArrow(apply, from_arrow_schema(schema)), "words", "zstd")


def pack_lists(sizes: np.ndarray, docs: np.ndarray, counts: np.ndarray) -> bytes:
    """The postings of a block: how many documents each has, these, and how often it stands in each."""
    return b"".join([np.array([len(sizes), len(docs)], "<u4").tobytes(), sizes.astype("<u4").tobytes(), counts.astype("<u4").tobytes(), docs.astype("<u2").tobytes()])


def open_lists(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``pack_lists`` undone, with the posting's place for every document instead of the sizes."""
    n, m = np.frombuffer(raw, "<u4", 2).astype(int).tolist()
    sizes, counts = np.split(np.frombuffer(raw, "<u4", n + m, 8), [n])
    return np.repeat(np.arange(n), sizes), np.frombuffer(raw, "<u2", m, 8 + 4 * (n + m)).astype(np.int64), counts.astype(np.int64)


def id_counts(rows: DataFrame, n_ids: int) -> np.ndarray:
    """How often each subword id stands in the training texts; a row for each id of the vocabulary comes to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_ids, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), "<u2"), minlength=n_ids)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["token", "n"])

    found = rows.where("doc IS NOT NULL AND NOT held_out").select("ids").mapInArrow(count, "token long, n long")
    found = found.groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(n_ids, np.int64)
    counts[np.asarray(found["token"])] = np.asarray(found["n"])
    return counts


def train(rows: DataFrame, tree: Tree, end: int, rounds: int = ROUNDS, share: int | None = None) -> np.ndarray:
    """The weight table after ``rounds`` rounds, which together take every training window once.

    The windows are dealt to ``share`` parts (``rounds`` of them, if not given) and the parts to the rounds."""
    parts_ = max(rounds, share or rounds)
    table = initial_weights(len(tree.sizes))
    names = [f"d{k}" for k in range(DIMS)]
    texts = rows.where("doc IS NOT NULL AND NOT held_out").select("block", "doc", "ids")
    for turn in range(rounds):

        def learn(batches: Iterator[pa.RecordBatch], turn: int = turn, table: np.ndarray = table) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(tree, table)
            for batch in batches:
                blobs = batch.column("ids").to_pylist()
                marks = (np.asarray(batch.column("block")) << DOC_BITS) + np.asarray(batch.column("doc"))
                for lo, hi in groups_of([len(b) // 2 for b in blobs], BATCH_IDS, lambda: len(blobs)):
                    stream = Stream.of(blobs[lo:hi], end)
                    text, place, first = windows(stream.sizes, WINDOW)
                    mixed = (marks[lo:hi][text].astype(np.uint64) * np.uint64(1_000_003) + place.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                    chosen = np.flatnonzero((mixed >> np.uint64(33)) % np.uint64(parts_) % np.uint64(rounds) == turn)
                    for k in range(0, len(chosen), STEP_WINDOWS):
                        own = chosen[k:k + STEP_WINDOWS]
                        trainer.step(*stream.batch(text[own], place[own], 0 * place[own]))
            rows_, uses, changes = trainer.changes()
            yield pa.RecordBatch.from_arrays([pa.array(rows_), pa.array(uses), *(pa.array(np.ascontiguousarray(c)) for c in changes.T)], ["row", "uses", *names])

        changes = texts.mapInArrow(learn, "row long, uses double, " + ", ".join(f"{n} float" for n in names))
        mean = changes.groupBy("row").agg(*[(F.sum(F.col(n) * F.col("uses")) / F.sum("uses")).alias(n) for n in names]).toArrow()
        table = table.copy()
        table[np.asarray(mean["row"])] += np.stack([np.asarray(mean[n]) for n in names], 1).astype(np.float32)
    return table


def score_ids(rows: DataFrame, tree: Tree, table: np.ndarray, end: int) -> DataFrame:
    """The documents of ``read_corpus`` without their ids, with ``score``: the model's log10 probability."""
    docs = rows.where("doc IS NOT NULL").select("block", "doc", "id", "held_out", "n_tokens", "ids")
    schema = docs.drop("ids").schema.add("score", "double")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column("ids").to_pylist()
            scores = [score_stream(tree, table, Stream.of(blobs[lo:hi], end)) for lo, hi in groups_of([len(b) // 2 for b in blobs], BATCH_IDS, lambda: len(blobs))]
            if blobs:
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.concatenate(scores) / np.log(10))], names=schema.names)

    return docs.mapInArrow(apply, schema)


def add_base(rows: DataFrame, scored: DataFrame) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score): the scored documents with the
    unigram base of the training words, whose counts return to the documents through the postings."""
    held = rows.where("word IS NOT NULL").select("block", "place", "word", "trained")
    counts = materialize(held.groupBy("word").agg(F.sum("trained").alias("c")), "word-counts", "zstd")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    room = float(np.log10(n + SMOOTHING * (v + 1)))
    found = held.drop("trained").join(counts, "word").select("block", "place", "c")
    docs = scored.unionByName(rows.where("lists IS NOT NULL").select("block", "lists"), allowMissingColumns=True).withColumnRenamed("block", "home")

    def back(own: pa.Table, found: pa.Table) -> pa.Table:
        place, doc, times = open_lists(own.filter(own["lists"].is_valid())["lists"][0].as_py())
        own = own.filter(own["lists"].is_null())
        at = np.asarray(own["doc"])
        c = np.zeros(found.num_rows, np.int64)
        c[np.asarray(found["place"])] = np.asarray(found["c"])
        known = np.bincount(doc, weights=times * (c > 0)[place], minlength=int(at.max()) + 1)
        base = np.bincount(doc, weights=times * (np.log10(c + SMOOTHING) - room)[place], minlength=len(known))
        return pa.table({"id": own["id"], "held_out": own["held_out"], "n_tokens": own["n_tokens"], "n_known": known[at].astype(np.int64),
                         "train_tokens": np.full(len(at), n, np.int64), "base_score": base[at], "score": own["score"]})

    schema = docs.select("id", "held_out", "n_tokens", F.lit(0).cast("long").alias("n_known"), F.lit(0).cast("long").alias("train_tokens"),
                         F.lit(0.0).alias("base_score"), "score").schema
    return docs.groupBy("home").cogroup(found.groupBy("block")).applyInArrow(back, schema)


def score_texts(docs: DataFrame, id_col: str, text_col: str, path: str, pattern: str,
                rounds: int = ROUNDS, share: int | None = None) -> DataFrame:
    """Train on all texts that are not held out and score all of them."""
    n_ids = len(read_ranks(path)) + 1
    end = n_ids - 1
    rows = read_corpus(docs, id_col, text_col, path, pattern, end)
    tree = huffman(id_counts(rows, n_ids))
    return add_base(rows, score_ids(rows, tree, train(rows, tree, end, rounds, share), end))
