"""Cross-tokenizer alignment by inverted pair bitmaps (operator 12).

Every text is encoded by two tokenizers, A (byte-level BPE, a ``tokenizers`` file) and B
(``sentencepiece``); the byte offsets where tokens of both end cut them into groups, and an A
and a B token of one group are a link.  A task takes its documents in blocks and inverts each:
for every id pair a compressed bitmap of the documents that hold it linked, with multiplicity
planes for how many links each has (module ``postings``).  OR-merged over the blocks and
popcounted, they give a pair's documents and links in the corpus; joined back to the postings,
which are dealt by block, they give every document the scores of its links.

The text is cut where a space stands between two other characters than white space: no token
of A or B reaches across such a place but for the leading space, so the tokens of a text are
those of its chunks, and each distinct chunk is encoded and aligned once a worker.  A text
with a chunk whose bytes a tokenizer changes is taken whole.

Nulls and edges: a null or empty text, or one whose bytes a tokenizer changes, has no tokens,
zeros and no groups (''); long texts are taken whole; every row is a document of its own, also
rows with the same or a null id; ties of a pair's count are all best; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

from . import chunks
from .common import materialize, tokenizer_pattern
from .postings import Block, document_count, groups_of, incidences, occurrence_count, postings, record

BATCH_CHARS = 2_000_000
CACHE_CHUNKS = 200_000
#: Longer chunks go to the tokenizer of A itself.
QUICK_CHARS = 500
#: Links of a group beyond which its ids are made distinct before they are paired.
WIDE_GROUP = 1 << 12
_UNEVEN = re.compile(r"\s | \s")
_CUT = re.compile(r"(?<=\S)(?= \S)")


def cut(text: str) -> list[str]:
    """Chunks of a space and ``text``: each begins with a space."""
    if not text.startswith(" ") and not text.endswith(" ") and _UNEVEN.search(text) is None:
        return [" " + x for x in text.split(" ")]
    return _CUT.split(" " + text)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one range after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class Tokens:
    """One tokenizer: the ids of many texts one after another and how many each has, and the bytes of each id."""

    def __init__(self, encode, pieces: list[bytes]):
        self.encode, self.pieces = encode, pieces
        self.sizes = np.array([len(p) for p in pieces], np.int64)

    def spell(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids.tolist()))

    def lengths(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The bytes of each text's tokens."""
        ends = np.cumsum(counts)
        total = np.r_[0, np.cumsum(self.sizes[ids])]
        return total[ends] - total[ends - counts]


def byte_level(path: str) -> Tokens:
    """A: a byte-level ``tokenizers`` file; texts are given with their leading space.

    Chunks of ASCII that no white space ends go through ``tiktoken`` with the file's own vocabulary,
    all in one call: its splitting and merging are the same there, and it ends a token where a
    chunk ends.  The others go to the file's own tokenizer.
    """
    import tiktoken
    from tokenizers import Tokenizer
    encoder, tok = chunks.tokenizers_encoder(path, "<u2"), Tokenizer.from_file(path)
    byte_of = {letter: b for b, letter in enumerate(chunks._byte_letters())}
    names = [tok.id_to_token(i) for i in range(tok.get_vocab_size())]
    plain = [all(c in byte_of for c in x) and i not in tok.get_added_tokens_decoder() for i, x in enumerate(names)]
    pieces = [bytes([byte_of[c] for c in x]) if p else x.encode() for x, p in zip(names, plain)]
    ranks = {x: i for i, (x, p) in enumerate(zip(pieces, plain)) if p}
    quick = tiktoken.Encoding("ascii", pat_str=tokenizer_pattern(), mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(encoder.number) > CACHE_CHUNKS:
            encoder.clear()
        easy = np.array([t.isascii() and len(t) <= QUICK_CHARS and not t[-1].isspace() for t in texts], bool)
        joined = [t for t, e in zip(texts, easy.tolist()) if e]
        first = np.array(quick.encode_ordinary("".join(joined)), np.int64)
        ends = np.searchsorted(np.cumsum(tokens.sizes[first]), np.cumsum([len(t) for t in joined]), "right")
        rest = encoder.encode([t for t, e in zip(texts, easy.tolist()) if not e])
        counts = np.zeros(len(texts), np.int64)
        counts[easy] = np.diff(ends, prepend=0)
        counts[~easy] = [len(x) // 2 for x in rest]
        ids = np.r_[first, np.frombuffer(b"".join(rest), "<u2")]
        starts = np.zeros(len(texts), np.int64)
        starts[easy] = np.cumsum(counts[easy]) - counts[easy]
        starts[~easy] = len(first) + np.cumsum(counts[~easy]) - counts[~easy]
        return ids[ragged(starts, counts)], counts

    tokens = Tokens(encode, pieces)
    return tokens


def sentence_pieces(path: str) -> Tokens:
    """B: a ``sentencepiece`` model, which puts the leading space itself."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    pieces = [bytes([int(x[3:5], 16)]) if model.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = model.encode([t[1:] for t in texts], num_threads=1)
        return np.fromiter(chain.from_iterable(found), np.int64), np.array([len(x) for x in found], np.int64)

    return Tokens(encode, pieces)


class Aligned:
    """Alignments of many chunks, in flat arrays: counts of each, its groups as text, its id pairs and their links."""

    def __init__(self):
        self.counts = np.zeros((0, 4), np.int64)  # n_a, n_b, n_groups, n_links
        self.texts: list[bytes] = []
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pairs, self.links = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def extend(self, other: Aligned) -> None:
        self.starts = np.r_[self.starts, other.starts + len(self.pairs)]
        self.counts = np.concatenate([self.counts, other.counts])
        self.texts += other.texts
        for name in ("sizes", "pairs", "links"):
            setattr(self, name, np.r_[getattr(self, name), getattr(other, name)])


def align(a_ids: tuple[np.ndarray, np.ndarray], b_ids: tuple[np.ndarray, np.ndarray], a: Tokens, b: Tokens) -> Aligned:
    """Alignments of chunks (ids and counts of both) whose tokens of A and of B spell the same bytes."""
    (ia, n_a), (ib, n_b) = a_ids, b_ids
    end_a, end_b = np.cumsum(a.sizes[ia]), np.cumsum(b.sizes[ib])
    cuts = np.intersect1d(end_a, end_b, assume_unique=True)
    ga, gb = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
    in_a, in_b = np.bincount(ga, minlength=len(cuts)), np.bincount(gb, minlength=len(cuts))
    chunk_a = np.repeat(np.arange(len(n_a)), n_a)
    group_chunk = chunk_a[np.cumsum(in_a) - 1]

    wide = in_a * in_b > WIDE_GROUP
    paired = np.where(wide[ga], 0, in_b[ga])
    left = np.repeat(np.arange(len(ia)), paired)
    right = ragged((np.cumsum(in_b) - in_b)[ga], paired)
    chunk, pairs, links = [chunk_a[left]], [ia[left] << 16 | ib[right]], [np.ones(len(left), np.int64)]
    for g in np.flatnonzero(wide).tolist():  # as many pairs as distinct ids make, whatever the group's length
        (x, cx), (y, cy) = (np.unique(ids[gs == g], return_counts=True) for ids, gs in ((ia, ga), (ib, gb)))
        pairs.append((x[:, None] << 16 | y).ravel())
        links.append((cx[:, None] * cy).ravel())
        chunk.append(np.full(len(x) * len(y), group_chunk[g]))
    chunk, pairs, links = map(np.concatenate, (chunk, pairs, links))
    if wide.any():
        order = np.argsort(chunk, kind="stable")
        chunk, pairs, links = chunk[order], pairs[order], links[order]

    order = np.argsort(np.r_[ga, gb], kind="stable")
    last = np.r_[ga[1:] != ga[:-1], True], np.r_[gb[1:] != gb[:-1], True]
    marks = np.r_[np.where(last[0], 1, 0), np.where(last[1], 2, 0)][order].tolist()
    words = [f"{i}{',|;'[m]}" for i, m in zip(np.r_[ia, ib][order].tolist(), marks)]
    ends = np.cumsum(n_a + n_b)

    out = Aligned()
    out.sizes = np.bincount(chunk, minlength=len(n_a))
    out.starts = np.cumsum(out.sizes) - out.sizes
    out.pairs, out.links = pairs, links
    out.texts = ["".join(words[x:y]).encode() for x, y in zip((ends - n_a - n_b).tolist(), ends.tolist())]
    groups = np.bincount(group_chunk, minlength=len(n_a))
    per_group = np.bincount(group_chunk, weights=in_a * in_b, minlength=len(n_a)).astype(np.int64)
    out.counts = np.stack([n_a, n_b, groups, per_group], 1)
    return out


class Aligner:
    """A worker's two tokenizers and its cache of aligned chunks."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = byte_level(a_path), sentence_pieces(b_path)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.known = Aligned()

    def _spelt(self, texts: list[str], a_ids: tuple, b_ids: tuple) -> np.ndarray:
        """Whether the tokens of both spell each text."""
        raw = [t.encode("utf-8", "replace") for t in texts]
        whole, sizes = b"".join(raw), np.array([len(r) for r in raw], np.int64)
        sides = [(self.a, *a_ids), (self.b, *b_ids)]
        if all((tok.lengths(ids, n) == sizes).all() and tok.spell(ids) == whole for tok, ids, n in sides):
            return np.ones(len(texts), bool)
        ok = np.ones(len(texts), bool)
        for tok, ids, n in sides:
            ends = np.cumsum(n)
            ok &= [tok.spell(ids[e - k:e]) == r for e, k, r in zip(ends.tolist(), n.tolist(), raw)]
        return ok

    def _add(self, missing: list[str]) -> None:
        """Align new chunks; one that a tokenizer changes gets the number -1."""
        a_ids, b_ids = self.a.encode(missing), self.b.encode(missing)
        ok = self._spelt(missing, a_ids, b_ids)
        base = len(self.known.texts)
        self.number.update(zip(missing, np.where(ok, base + np.cumsum(ok) - 1, -1).tolist()))
        if not ok.all():
            a_ids, b_ids = ((ids[np.repeat(ok, n)], n[ok]) for ids, n in (a_ids, b_ids))
        if ok.any():
            self.known.extend(align(a_ids, b_ids, self.a, self.b))

    def documents(self, texts: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """Counts (n_a, n_b, n_groups, n_links) and groups of each text, and (pair, text, links) of them all."""
        if len(self.number) > CACHE_CHUNKS:
            self.clear()
        split = [cut(t) if t else [] for t in texts]
        missing = {c for parts in split for c in parts}
        missing.difference_update(self.number)
        if missing:
            self._add(list(missing))
        get, known = self.number.__getitem__, self.known
        at = [list(map(get, parts)) for parts in split]
        odd = [i for i, x in enumerate(at) if -1 in x]
        whole: dict[int, Aligned] = {}
        for i in odd:
            at[i] = []
            a_ids, b_ids = self.a.encode([" " + texts[i]]), self.b.encode([" " + texts[i]])
            if self._spelt([" " + texts[i]], a_ids, b_ids)[0]:
                whole[i] = align(a_ids, b_ids, self.a, self.b)
        ix = np.fromiter((k for x in at for k in x), np.int64)
        doc = np.repeat(np.arange(len(texts)), [len(x) for x in at])
        counts = np.stack([np.bincount(doc, weights=known.counts[ix, k], minlength=len(texts)) for k in range(4)], 1).astype(np.int64)
        groups = [b"".join([known.texts[k] for k in x])[:-1] for x in at]
        sizes = known.sizes[ix]
        flat = ragged(known.starts[ix], sizes)
        pairs, links, docs = [known.pairs[flat]], [known.links[flat]], [np.repeat(doc, sizes)]
        for i, x in whole.items():
            counts[i], groups[i] = x.counts[0], x.texts[0][:-1]
            pairs.append(x.pairs)
            links.append(x.links)
            docs.append(np.full(len(x.pairs), i))
        return counts, groups, *map(np.concatenate, (pairs, docs, links))


_WORKERS: dict[tuple[str, str], Aligner] = {}


def invert(docs: DataFrame, id_col: str, text_col: str, a_path: str, b_path: str, digest: bool = False) -> DataFrame:
    """Align every text and write the blocks to the shared folder.

    Returns one table of two kinds of rows, by ``pair``: null, a document (block, doc, id, n_a,
    n_b, n_groups, n_links, groups); else a posting (block, pair, bitmap, planes).  ``groups``
    is text as ``a1,a2|b1;a3|b2,b3`` or, with ``digest``, its lowercase hex sha256 ('' without tokens).
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    whole = pa.int64()
    schema = pa.schema([("block", whole), ("doc", pa.int32()), ("id", to_arrow_type(source.schema["id"].dataType)),
                        ("n_a", whole), ("n_b", whole), ("n_groups", whole), ("n_links", whole), ("groups", pa.string()),
                        ("pair", whole), ("bitmap", pa.binary()), ("planes", pa.binary())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        if (a_path, b_path) not in _WORKERS:
            _WORKERS[a_path, b_path] = Aligner(a_path, b_path)
        aligner, block = _WORKERS[a_path, b_path], Block(TaskContext.get().partitionId())

        def closed() -> pa.RecordBatch:
            number = block.number
            pairs, _, bitmaps, planes = postings(*block.close())
            return record(schema, pair=pairs, block=np.full(len(pairs), number), bitmap=bitmaps, planes=planes)

        for batch in batches:
            ids, texts = batch.column("id"), [t or "" for t in batch.column("text").to_pylist()]
            for lo, hi in groups_of([len(t) for t in texts], BATCH_CHARS, block.room):
                counts, groups, pairs, doc, links = aligner.documents(texts[lo:hi])
                if digest:
                    groups = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
                yield record(schema, id=ids[lo:hi], block=np.full(hi - lo, block.number), doc=np.arange(block.docs, block.docs + hi - lo),
                             groups=[g if digest else g.decode() for g in groups],
                             **dict(zip(("n_a", "n_b", "n_groups", "n_links"), counts.T)))
                block.add(hi - lo, pairs, doc, links)
                if not block.room():
                    yield closed()
        if block.docs:
            yield closed()

    return materialize(source.mapInArrow(apply, from_arrow_schema(schema)), "pairs")


def pair_table(rows: DataFrame) -> DataFrame:
    """(pair, n_docs, n_links, best) of every id pair (a << 16 | b) of ``invert``: the documents and links
    that hold it, and whether no pair of the same A id has more documents."""
    held = rows.where("pair IS NOT NULL")
    pairs = held.groupBy("pair").agg(F.sum(document_count(F.col("bitmap"))).alias("n_docs"),
                                     F.sum(occurrence_count("bitmap", "planes")).alias("n_links"))
    pairs = materialize(pairs, "pair-counts")
    a = F.shiftright("pair", 16)
    most = pairs.groupBy(a.alias("a")).agg(F.max("n_docs").alias("most"))  # a row for each id of a vocabulary at most
    return pairs.join(F.broadcast(most), a == most["a"]).select("pair", "n_docs", "n_links", (F.col("n_docs") == F.col("most")).alias("best"))


def score_documents(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Each document of ``invert`` with n_best (its links whose pair is ``best``) and count_sum (their pairs' documents, summed)."""
    held = rows.where("pair IS NOT NULL").select("block", "pair", "bitmap", "planes")
    scored = held.join(pairs.select("pair", "n_docs", "best"), "pair").select(
        "block", "bitmap", "planes", document_count(F.col("bitmap")).alias("n"), F.col("n_docs").alias("documents"), "best")
    docs = rows.where("pair IS NULL").drop("pair", "bitmap", "planes").withColumnRenamed("block", "home")
    schema = docs.drop("home", "doc").schema
    names = list(schema.names)

    def back(own: pa.Table, lists: pa.Table) -> pa.Table:
        at = np.asarray(own.column("doc"))
        n = int(at.max()) + 1 if len(at) else 0
        place, doc, links = incidences(np.asarray(lists.column("n")), lists.column("bitmap"), lists.column("planes"))
        sums = []
        for weight in (np.asarray(lists.column("best")), np.asarray(lists.column("documents"))):
            total = np.zeros(n, np.int64)
            np.add.at(total, doc, links * weight.astype(np.int64)[place])
            sums.append(total[at])
        out = own.select(names)
        for name, values in zip(("n_best", "count_sum"), sums):
            out = out.append_column(name, pa.array(values))
        return out

    return docs.groupBy("home").cogroup(scored.groupBy("block")).applyInArrow(back, schema.add("n_best", "long").add("count_sum", "long"))
