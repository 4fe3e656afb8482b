"""Whole-text tokenization from a per-worker table of pieces.

The pre-tokenizers used here never join text across a single space that stands
between a chunk and a non-space character, nor a Latin or Cyrillic letter or digit
and the punctuation after it, so a text's ids are the ids of its pieces one after
another.  Each distinct piece is encoded once per worker; the table is emptied when
it is full, so memory is bounded.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections import defaultdict
from collections.abc import Callable
from itertools import chain, islice

import numpy as np

from .common import hold_cache, release_memory

CACHE_CHUNKS = 620_000
_BOUNDARY = re.compile(r"(?= \S)")
_ODD_SPACE = re.compile(r" \s")
_TWO_SPACES = re.compile(r"\s\s")
_LATIN_WORD = re.compile(" ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u024F]+")
_STOPS = ".,;:!?"
#: Punctuation that may belong to what stands before it; dotted capital I is left out since lower-casing turns it into a letter and a mark, which is no letter.
_JOINED_STOP = re.compile("[.,;:!?](?<=[^0-9A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u024F\u0400-\u0481\u048A-\u052F][.,;:!?])")
_TAIL = ".,;:!?*#$%&()|\""
_ENDS = frozenset(_TAIL)


def split_chunks(text: str) -> list[str]:
    """Chunks of ``text``: cut before every space that a non-space follows."""
    if _ODD_SPACE.search(text) is None and not text.startswith(" ") and not text.endswith(" "):
        first, *rest = text.split(" ")
        return [first, *[" " + x for x in rest]]
    return _BOUNDARY.split(text)


def split_pieces(text: str) -> list[str]:
    """Chunks of ``text``, in plain text cut further around line ends and before the stops after a letter or digit."""
    if "\0" in text or text[:1].isspace() or text[-1:].isspace() or _TWO_SPACES.search(text) or _JOINED_STOP.search(text):
        return split_chunks(text)
    text = text.replace(" ", "\0 ").replace("\n", "\0\n\0")
    for stop in _STOPS:
        text = text.replace(stop, "\0" + stop)
    return text.split("\0")


class ChunkEncoder:
    """Encodes texts to little-endian id bytes through ``encode_many(list[str])``, which gives a list of ids or their bytes for each.

    Pieces are numbered as they come, and their ids stand one after another in an array.  A new chunk is put
    together from its parts (lines; words and the ASCII punctuation after them), since the pre-tokenizers cut
    between these.
    """

    def __init__(self, encode_many: Callable[[list[str]], list], dtype: str, encode_words: Callable[[list[str]], list] | None = None,
                 cache_chunks: int = CACHE_CHUNKS):
        """``encode_words``: a quicker way for words of Latin letters alone, with or without a space before."""
        self.cache_chunks = cache_chunks
        self.encode_many, self.encode_words, self.dtype = encode_many, encode_words, np.dtype(dtype)
        self.clear()

    def clear(self) -> None:
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.sizes, self.starts, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.dtype)

    @staticmethod
    def _pieces(chunk: str) -> list[str]:
        """Parts that are pre-tokenized apart: lines within the chunk, and the punctuation after a letter or digit."""
        lines = chunk.split("\n") if "\n" in chunk else [chunk]
        if len(lines) > 1 and not all(x and not x[-1].isspace() and (i == 0 or not x[0].isspace()) for i, x in enumerate(lines)):
            return [chunk]
        parts = []
        for i, line in enumerate(lines):
            if i:
                parts.append("\n")
            core = line.rstrip(_TAIL)
            # lower-casing turns a dotted capital I into a letter and a mark, which is no letter, and NFC some Indic letters
            if core and len(core) < len(line) and unicodedata.normalize("NFC", core[-1])[-1].isalnum() and core[-1] != "\u0130":
                parts += [core, line[len(core):]]
            else:
                parts.append(line)
        return parts

    def _learn(self) -> None:
        """Ids of the pieces that were numbered since the last call."""
        number, known = self.number, len(self.sizes)
        if len(number) == known:
            return
        words, others, split = [], [], {}
        self._sort(known, words, others)
        at = len(number)
        for chunk in others:
            if chunk[-1:] in _ENDS or "\n" in chunk:
                parts = self._pieces(chunk)
                if len(parts) > 1:
                    split[chunk] = list(map(number.__getitem__, parts))
        others = [x for x in others if x not in split]
        self._sort(at, words, others)
        found = self.encode_words(words) if words else []
        self._keep(words, list(map(len, found)), np.fromiter(chain.from_iterable(found), self.dtype))
        self._keep_bytes(others, list(map(self._bytes, self.encode_many(others))))
        self._keep_bytes(list(split), [b"".join(map(self._of, parts)) for parts in split.values()])

    def _sort(self, start: int, words: list[str], others: list[str]) -> None:
        """Deals the pieces numbered from ``start`` on to the words of Latin letters and the others."""
        new = list(islice(reversed(self.number), len(self.number) - start))  # not past all that are known
        new.reverse()
        if self.encode_words is None:
            others.extend(new)
            return
        is_word = _LATIN_WORD.fullmatch
        for piece in new:
            (words if piece.removeprefix(" ").isalpha() and (piece.isascii() or is_word(piece)) else others).append(piece)

    def _keep(self, pieces: list[str], sizes: list[int], ids: np.ndarray) -> None:
        more = np.zeros(len(self.number) - len(self.sizes), np.int64)
        self.sizes, self.starts = np.concatenate([self.sizes, more]), np.concatenate([self.starts, more])
        at = np.fromiter(map(self.number.__getitem__, pieces), np.int64, len(pieces))
        self.sizes[at] = sizes
        self.starts[at] = len(self.ids) + np.cumsum(self.sizes[at]) - self.sizes[at]
        self.ids = np.concatenate([self.ids, ids])

    def _keep_bytes(self, pieces: list[str], blobs: list[bytes]) -> None:
        self._keep(pieces, [len(b) // self.dtype.itemsize for b in blobs], np.frombuffer(b"".join(blobs), self.dtype))

    def _of(self, number: int) -> bytes:
        at = self.starts[number]
        return self.ids[at:at + self.sizes[number]].tobytes()

    def _bytes(self, ids: list | bytes) -> bytes:
        if isinstance(ids, bytes):
            return ids
        return array(self._code, ids).tobytes() if isinstance(ids, list) else np.asarray(ids, self.dtype).tobytes()

    @property
    def _code(self) -> str:
        return "H" if self.dtype.itemsize == 2 else "I"

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.number) > self.cache_chunks:
            self.clear()
            release_memory()
        split = [split_pieces(t) for t in texts]
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        keys = np.fromiter(map(self.number.__getitem__, chain.from_iterable(split)), np.int64, int(lengths.sum()))
        self._learn()
        sizes = self.sizes[keys]
        ends = np.cumsum(sizes)
        raw = self.ids[np.repeat(self.starts[keys] - ends + sizes, sizes) + np.arange(sizes.sum())].tobytes()
        cuts = (np.r_[0, ends][np.r_[0, np.cumsum(lengths)]] * self.dtype.itemsize).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


_ENCODERS: dict[tuple[str, str], ChunkEncoder] = {}


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes for
    themselves, the others for code points from 256 on, in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def _word_encoder(tok) -> Callable[[list[str]], list] | None:
    """Ids of words of Latin letters straight from the tokenizer's model.

    Such a word is a single pre-token, so only normalisation and the byte alphabet come
    before the model; whether this gives the tokenizer's own ids is tried on samples.
    """
    letters, tokenize = _byte_letters(), tok.model.tokenize
    table = {c: letters[c] for c in range(128)}

    def spell(word: str) -> str:
        return word.translate(table) if word.isascii() else "".join([letters[b] for b in word.encode()])

    def direct(words: list[str]) -> list:
        return [[t.id for t in tokenize(spell(word))] for word in words]

    # NFC and the like leave ASCII letters alone; where the normaliser lower-cases these and no more, Python does so too
    ascii_letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowers = tok.normalizer is not None and all(tok.normalizer.normalize_str(x) == x.lower() for x in (ascii_letters, *ascii_letters))

    def normalised(bare: list[str]) -> list[str]:
        """Normalised in one call, with spaces between the words."""
        plain = tok.normalizer.normalize_str(" ".join(bare)).split(" ") if bare else []
        return plain if len(plain) == len(bare) else [tok.normalizer.normalize_str(word).strip() for word in bare]

    def normal(words: list[str]) -> list:
        """Words that become equal by normalisation are tokenized once."""
        bare = [word.strip() for word in words]
        odd = [word for word in bare if not (lowers and word.isascii())]
        other = dict(zip(odd, normalised(odd)))
        plain = [other[word] if word in other else word.lower() for word in bare]
        once = list(dict.fromkeys(plain))
        return list(map(dict(zip(once, direct(once))).__getitem__, plain))

    samples = [" The", "the", " Straße", " ÉTÉ", "niño", " Über", "ciónmente", " x", " ǅ"]
    for way in (direct, normal if tok.normalizer is not None else direct):
        if way(samples) == [tok.encode(w, add_special_tokens=False).ids for w in samples]:
            return way
    return None


def tokenizers_encoder(path: str, dtype: str, cache_chunks: int = CACHE_CHUNKS) -> ChunkEncoder:
    """The worker's encoder for a ``tokenizers`` file, without special tokens."""
    hold_cache("chunks", _ENCODERS.clear)
    if (path, dtype) not in _ENCODERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True

        def encode_many(chunks: list[str]) -> list:
            return [e.ids for e in tok.encode_batch_fast(chunks, add_special_tokens=False)]

        _ENCODERS[path, dtype] = ChunkEncoder(encode_many, dtype, _word_encoder(tok), cache_chunks)
    return _ENCODERS[path, dtype]


def vocabulary_dtype(path: str) -> str:
    """The narrowest of u2 and u4 that holds every id of a ``tokenizers`` file."""
    from tokenizers import Tokenizer
    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"
