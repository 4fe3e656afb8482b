"""Language identification by error-correcting output codes (operator 5).

Each language has a codeword of bits.  For each bit a binary classifier over hashed
character n-grams (orders 1 to 3) weighs the languages whose bit is set against the
others; its weights come from n-gram counts over all training documents, added up
in Spark.  A text's bit margins are decoded to the codeword of least loss, each bit's
loss weighted by how often its classifier is right for that language on training
documents; a small gap to the second codeword marks the text as ambiguous.

The calibration (bit weights and the margins' scale) uses a sample of about
``CALIBRATION_ROWS`` training documents, chosen by a hash; the counts use all.

Nulls and edges: a text that is null or has no letter is ``und`` with score 0, and so
is every text if nothing is there to learn from; documents without a language do not
train; texts of any length are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hold_cache, scratch_column, slices

BUCKET_BITS = 14
ORDERS = (1, 2, 3)
CALIBRATION_ROWS = 4000
AMBIGUOUS_GAP = 0.02
BATCH_CHARS = 500_000
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """The lower-case words of a text, spaced; empty if it has no letter."""
    if not text:
        return ""
    words = _NOT_LETTERS.sub(" ", text.lower()).strip()
    return f" {words} " if words and any(map(str.isalpha, words)) else ""


def ngram_buckets(text: str) -> list[np.ndarray]:
    """Hash buckets of a text's n-grams, an array for each order."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    found, h = [], points * np.uint64(0x9E3779B97F4A7C15)
    for order in ORDERS:
        if order > 1:
            h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + points[order - 1:] * np.uint64(0x94D049BB133111EB)
        mixed = (h + np.uint64(order)) * np.uint64(0xD6E8FEB86659FD93)
        found.append((mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    return found


def codewords(k: int) -> np.ndarray:
    """k codewords of +1 and -1: all splits of the languages for few of them, else a seeded dense code."""
    if k < 2:
        return np.ones((k, 1), np.int8)
    if k <= 6:  # every way to part the languages in two
        splits = [s for size in range(1, k) for s in combinations(range(k), size) if 0 in s]
        return np.array([[1 if i in s else -1 for s in splits] for i in range(k)], np.int8)
    bits, rng, best = 10 * int(np.ceil(np.log2(k))), np.random.default_rng(7), None
    for _ in range(100):
        code = rng.integers(0, 2, (k, bits)) * 2 - 1
        if (np.abs(code.sum(0)) == k).any():
            continue
        apart = min(int((code[i] != code[j]).sum()) for i, j in combinations(range(k), 2)) if k < 200 else int((code[1:] != code[:-1]).sum(1).min())
        if best is None or apart > best[0]:
            best = (apart, code)
    return best[1].astype(np.int8)


class Model:
    """What ``train`` learned: languages, codewords, n-gram weights, bit weights and scale."""

    def __init__(self, langs: list[str], code: np.ndarray, weights: np.ndarray):
        self.langs, self.code, self.weights = langs, code, weights
        self.bit_weights, self.scale = np.ones(code.shape) / code.shape[1], 1.0

    def margins(self, texts: list[str]) -> np.ndarray:
        """Mean n-gram weight of each bit for texts that have letters."""
        out = np.zeros((len(texts), self.code.shape[1]))
        for i, text in enumerate(texts):
            n = 0
            for lo in range(0, len(text), BATCH_CHARS):  # a very long text by parts that overlap
                for buckets, order in zip(ngram_buckets(text[lo:lo + BATCH_CHARS + ORDERS[-1] - 1]), ORDERS):
                    buckets = buckets[:BATCH_CHARS]
                    out[i] += self.weights[buckets].sum(0)
                    n += len(buckets)
            out[i] /= max(n, 1)
        return out

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of every text for every codeword."""
        m = margins[:, None, :] * self.scale * self.code[None, :, :]
        return (np.logaddexp(0, -m) * self.bit_weights[None, :, :]).sum(2)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest codeword, score (0 to 1) and gap between the two least losses."""
        losses = self.losses(margins)
        best = losses.argmin(1)
        odds = np.exp(-4.0 * (losses - losses.min(1, keepdims=True)))
        ordered = np.sort(losses, 1)
        gap = ordered[:, 1] - ordered[:, 0] if losses.shape[1] > 1 else np.ones(len(best))
        return best, 1.0 / odds.sum(1), gap


def train(rows: DataFrame, text_col: str, lang_col: str, calibration_rows: int = CALIBRATION_ROWS) -> Model | None:
    """Learn from all ``rows`` with a language; None if there is none."""
    size = 1 << BUCKET_BITS

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold_cache("langid", dict)  # it keeps none
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                text = letters(text)
                if text:
                    have = counts.setdefault(lang, np.zeros(size, np.int64))
                    for lo in range(0, len(text), BATCH_CHARS):
                        for buckets in ngram_buckets(text[lo:lo + BATCH_CHARS + ORDERS[-1] - 1]):
                            have += np.bincount(buckets[:BATCH_CHARS], minlength=size)
        for lang, have in counts.items():
            at = np.flatnonzero(have)
            yield pd.DataFrame({"lang": lang, "bucket": at, "n": have[at]})

    known = rows.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("lang IS NOT NULL")
    summed = (known.mapInPandas(count, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())  # languages x buckets at most
    if summed.empty:
        return None
    langs = sorted(summed["lang"].unique())
    counts = np.zeros((len(langs), size))
    counts[summed["lang"].map({x: i for i, x in enumerate(langs)}), summed["bucket"]] = summed["n"]
    share = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True)  # every language counts alike
    code = codewords(len(langs))
    weights = np.zeros((size, code.shape[1]))
    for b in range(code.shape[1]):
        own, other = code[:, b] > 0, code[:, b] < 0
        if other.any():
            weights[:, b] = np.log(share[own].mean(0)) - np.log(share[other].mean(0))
    model = Model(langs, code, weights.astype(np.float32))
    return calibrate(model, known, calibration_rows)


def calibrate(model: Model, known: DataFrame, rows: int) -> Model:
    """Scale the margins and weigh each language's bits by their accuracy on sampled training rows."""
    n = known.count()
    part = known.filter((F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, rows / max(n, 1)))))
    langs = model.langs

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold_cache("langid", dict)
        for batch in batches:
            texts = [letters(t) for t in batch["text"]]
            kept = [i for i, t in enumerate(texts) if t]
            if not kept:
                continue
            margins = model.margins([texts[i] for i in kept])
            own = model.code[[langs.index(batch["lang"].iloc[i]) for i in kept]]
            yield pd.DataFrame({"lang": [batch["lang"].iloc[i] for i in kept], "right": list((margins * own > 0).astype(float)), "size": list(np.abs(margins))})

    sums = (part.mapInPandas(measure, "lang string, right array<double>, size array<double>")
            .select("lang", F.posexplode(F.arrays_zip("right", "size")).alias("bit", "x"))
            .groupBy("lang", "bit").agg(F.avg("x.right").alias("right"), F.avg("x.size").alias("size")).collect())
    right = np.ones(model.code.shape)
    for r in sums:
        right[langs.index(r["lang"]), r["bit"]] = r["right"]
    right = np.maximum(right, 0.05)
    model.bit_weights = right / right.sum(1, keepdims=True)
    sizes = [r["size"] for r in sums if r["size"]]
    model.scale = 4.0 / float(np.mean(sizes)) if sizes else 1.0
    return model


PREDICTION = "lang_pred string, score double, ambiguous boolean"


def prediction(text: Column, model: Model | None) -> Column:
    """The struct (lang_pred, score, ambiguous) of a text column; nothing else is looked at."""

    @F.pandas_udf(PREDICTION)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hold_cache("langid", dict)
        for batch in batches:
            texts = [letters(t) for t in batch]
            langs = [UNKNOWN] * len(texts)
            scores, unsure = np.zeros(len(texts)), np.ones(len(texts), bool)
            if model is not None:
                for lo, hi in slices([len(t) for t in texts], BATCH_CHARS):
                    at = [i for i in range(lo, hi) if texts[i]]
                    if at:
                        best, s, gap = model.decode(model.margins([texts[i] for i in at]))
                        scores[at], unsure[at] = s, gap < AMBIGUOUS_GAP
                        for i, b in zip(at, best):
                            langs[i] = model.langs[b]
            yield pd.DataFrame({"lang_pred": langs, "score": scores, "ambiguous": unsure})

    return apply(text)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Learn from the rows whose crc32(id) mod 4 is not 2 (a null id is in no remainder and does not train)."""
    return train(docs.filter(held_out(id_col) == F.lit(False)), text_col, lang_col)


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score, ambiguous) of every document; learns by ``fit``."""
    model = fit(docs, id_col, text_col, lang_col)
    return (docs.select(F.col(id_col).alias("id"), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"),
                        prediction(F.col(text_col), model).alias("language"))
            .select("id", "held_out", "language.*"))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without those that are ``und`` or ambiguous."""
    mark = scratch_column(docs, "language")
    found = docs.withColumn(mark, prediction(F.col(text_col), fit(docs, id_col, text_col, lang_col)))
    return found.filter((F.col(f"{mark}.lang_pred") != UNKNOWN) & ~F.col(f"{mark}.ambiguous")).drop(mark)
