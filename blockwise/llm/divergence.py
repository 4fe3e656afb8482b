"""Quality rules by distribution divergence (operator 9).

For every language of the corpus two reference histograms are counted over all its
documents: character classes, and its most frequent words with all others as one bin.
A document is compared with its own language's references (with every language's,
the nearest counting, if its language has none) by Jensen-Shannon distance.  A
distance counts only for documents of a minimum length, since short texts are far
from any reference by chance.

Nulls and edges: a null text has no words and fails the base rules; a null language
adds to no reference; an empty table gives no rows; repeated rows are scored alike.
Texts of any length are read whole, a slice of documents at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, slices

COMMON_WORDS = 100
MIN_CHAR_WORDS = 50      # words a document needs for the character-class distance to count
MIN_COMMON_WORDS = 100   # and for the common-word distance
MAX_CHAR_DISTANCE = 0.22
MAX_WORD_DISTANCE = 0.47
BATCH_CHARS = 2_000_000
FLUSH_WORDS = 300_000
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
STRIP = ".,;:!?*#$%&()|<>\"'"

CLASSES = ("lower", "upper", "digit", "space", "stop", "symbol", "accented", "other")
_TABLE_SIZE = 0x250  # Latin letters; beyond it everything is "other"


def _class_of(c: str) -> int:
    if c in SPACES:
        return 3
    if c.isascii():
        return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 4 if c in ".,;:!?'\"-()" else 5
    return 6 if c.isalpha() else 7


_TABLE = np.array([*(_class_of(chr(i)) for i in range(_TABLE_SIZE)), 7], np.uint8)


def class_counts(text: str) -> np.ndarray:
    """Characters of each class."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.bincount(_TABLE[np.minimum(points, _TABLE_SIZE)], minlength=len(CLASSES))


def _repeated(ids: np.ndarray, distinct: int) -> int:
    """Words that lie in a 3-word window which the text holds twice or more."""
    if len(ids) < 4:
        return 0
    pair = ids[:-1] * np.int64(distinct) + ids[1:]
    if distinct > 1 << 20:
        pair = np.unique(pair, return_inverse=True)[1]
        distinct = len(ids)
    _, at, times = np.unique(pair[:-1] * np.int64(distinct) + ids[2:], return_inverse=True, return_counts=True)
    again = times[at] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift:shift + len(again)] |= again
    return int(covered.sum())


def word_stats(text: str | None) -> tuple[tuple[int, int, int, int, int], dict[str, int]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the text's word counts."""
    if not text:
        return (0, 0, 0, 0, 0), {}
    words = text.encode("utf-8", "surrogatepass").split()  # bytes split at the six ASCII spaces alone
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    seen: set[str] = set()
    lines = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            seen.add(line)
    counts: dict[str, int] = {}
    for w, n in zip(index, np.bincount(ids, minlength=len(index)).tolist()):
        w = w.decode("utf-8", "surrogatepass").lower().strip(STRIP)
        counts[w] = counts.get(w, 0) + n
    stats = (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
             lines - len(seen), _repeated(ids, len(index)))
    return stats, counts


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms, base 2: 0 to 1 (1 if either is empty)."""
    a, b = float(p.sum()), float(q.sum())
    if not a or not b:
        return 1.0
    p, q = p / a, q / b
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return float(np.sqrt(min(1.0, max(0.0, parts.sum() / 2))))


def references(docs: DataFrame, text_col: str, lang_col: str, common_words: int = COMMON_WORDS) -> dict[str, tuple]:
    """Per language (class histogram, common words, their counts with the rest last), over all documents.

    Counted per task in a table of bounded size, summed by Spark; only the class counts and
    the ``common_words`` of each language reach the driver.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter = Counter()
        classes: dict[str, np.ndarray] = {}

        def flush() -> pd.DataFrame:
            rows = [(lang, "w", w, n) for (lang, w), n in words.items()]
            rows += [(lang, "c", str(i), int(n)) for lang, c in classes.items() for i, n in enumerate(c)]
            return pd.DataFrame(rows, columns=["lang", "kind", "key", "n"])

        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"]):
                if not text:
                    continue
                for w, n in Counter(text.encode("utf-8", "surrogatepass").split()).items():
                    words[lang, w.decode("utf-8", "surrogatepass").lower().strip(STRIP)] += n
                classes[lang] = classes.get(lang, 0) + class_counts(text)
                if len(words) > FLUSH_WORDS:
                    yield flush()
                    words.clear()
                    classes.clear()
        yield flush()

    known = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).filter("lang IS NOT NULL")
    counts = (known.mapInPandas(count, "lang string, kind string, key string, n long")
              .groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")))
    counts = materialize(counts, "reference-counts")  # read twice below
    top = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key")
    rest = counts.groupBy("lang").agg(F.sum(F.when(F.col("kind") == "w", F.col("n"))).alias("words")).filter("words IS NOT NULL")
    kept = counts.filter("key <> ''").withColumn("place", F.row_number().over(top)).filter(F.col("place") <= max(common_words, len(CLASSES)))
    found: dict[str, tuple] = {}
    for r in kept.join(rest, "lang").orderBy("lang", "kind", "place").collect():  # languages x (classes + common words)
        classes, words, counted, _ = found.setdefault(r["lang"], (np.zeros(len(CLASSES)), [], [], r["words"]))
        if r["kind"] == "c":
            classes[int(r["key"])] = r["n"]
        elif len(words) < common_words:
            words.append(r["key"])
            counted.append(r["n"])
    return {lang: (c, w, np.array([*n, max(0, total - sum(n))], float)) for lang, (c, w, n, total) in found.items()}


def score(docs: DataFrame, id_col: str, text_col: str, lang_col: str, refs: dict[str, tuple],
          max_char: float = MAX_CHAR_DISTANCE, max_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """The base counts, the two distances and the verdict of every document."""
    places = {lang: {w: i for i, w in enumerate(words)} for lang, (_, words, _) in refs.items()}

    def compare(classes: np.ndarray, counts: dict[str, int], lang: str) -> tuple[float, float]:
        reference, words, expected = refs[lang]
        place, seen = places[lang], np.zeros(len(words) + 1)
        for w, n in counts.items():
            seen[place.get(w, -1)] += n
        return distance(classes, reference), distance(seen, expected)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo, hi in slices([len(t) if t else 0 for t in batch["text"]], BATCH_CHARS):
                out = []
                for key, text, lang in batch.iloc[lo:hi].itertuples(index=False):
                    stats, counts = word_stats(text)
                    n, failed = stats[0], stats[0] < 50 or 100 * stats[4] > 50 * stats[0]
                    char = word = None
                    if n and refs:
                        classes = class_counts(text)
                        char, word = min((compare(classes, counts, x) for x in ([lang] if lang in refs else refs)), key=sum)
                    far = char is not None and (n >= MIN_CHAR_WORDS and char > max_char or n >= MIN_COMMON_WORDS and word > max_word)
                    out.append((None if pd.isna(key) else int(key), *stats, failed, not failed and not far, char, word))
                yield pd.DataFrame(out, columns=["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                                 "base_failed", "kept", "char_distance", "word_distance"]).astype({"id": "Int64"})

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    return rows.mapInPandas(judge, "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                                   "base_failed boolean, kept boolean, char_distance double, word_distance double")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Count the references over all documents, then judge every document."""
    return score(docs, id_col, text_col, lang_col, references(docs, text_col, lang_col))
