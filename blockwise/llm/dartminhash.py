"""Near-duplicate documents by DartMinHash signatures (operator 7).

A document is a weighted set of word 5-grams.  Hashed darts are thrown at every element's
region (its weight times an axis of ranks); an element's darts depend on the element
alone, so equal elements keep equal darts.  Each dart falls on one of ``COORDINATES``
coordinates, and a document keeps the earliest dart per coordinate.  Only ranks up to a
bound set by the document's total weight are thrown, so the work is about the number of
elements plus the number of darts; documents left with an empty coordinate go on to
higher ranks.  Two documents agree in a coordinate with a probability equal to their
weighted Jaccard similarity.  Signatures are cut into bands and documents that share a
band are candidates.

Equal texts are put together first, and only one of them is signed.  Candidates are
verified by exact similarity, ``THRESHOLD`` or more, in two rounds that lose no
candidate link and emit no group's pairs: every band's bucket is compared with its
first document, which merges all but strangers; then those pairs of a bucket that are
still in different classes are compared, unless their distances to the first document differ
by more than 1 - threshold (Jaccard distance is a metric, so they cannot be near), one of them has too many shingles that no other document of the buckets has, or
their sketches (a bit for each place that a shingle's hash falls on) differ in too many places for it.
Classes are the connected components of the verified links.

Nulls and edges: a null text is in a class of its own; texts of under five words are one
shingle, their whole word sequence, and a text without words matches only its equals;
words are lower-case, parted by white space; the result has one row per id: rows that
repeat an id are one document, with the text of least hash; rows without an id are left
out; an empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hold_cache, keep_keyed, key_test, materialize, scratch_column, slices

COORDINATES = 128
BAND_ROWS = 4
WORDS = 5
THRESHOLD = 0.8
BATCH_CHARS = 250_000
SKETCH_BITS = 2048
LOWEST = -12  # the first interval of ranks is [0, 2^LOWEST)
CACHE_WORDS = 200_000

_MULT = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_WORD_HASHES: dict[str, int] = {}


def _mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of a 64-bit hash."""
    h = (h ^ (h >> np.uint64(30))) * _MULT[1]
    h = (h ^ (h >> np.uint64(27))) * _MULT[2]
    return h ^ (h >> np.uint64(31))


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0 ** -53


def word_hashes(text: str) -> np.ndarray:
    if len(_WORD_HASHES) > CACHE_WORDS:
        _WORD_HASHES.clear()
    words = text.lower().split()
    for w in set(words).difference(_WORD_HASHES):
        _WORD_HASHES[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
    return np.fromiter(map(_WORD_HASHES.__getitem__, words), np.uint64, len(words))


def shingles(text: str, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the word n-grams of a text and how often each occurs."""
    h = word_hashes(text)
    if not len(h):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = min(words, len(h))
    total = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        total = _mix(total * _MULT[0] + h[i:len(h) - n + 1 + i])
    return np.unique(total, return_counts=True)


def _throw(elements: np.ndarray, low: float, high: float, salt: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Darts at each element's ranks [low, high): (element's index, coordinate, rank).

    The number of darts is Poisson with mean high - low, drawn from the element's hash.
    """
    width = high - low
    steps = np.arange(1, int(width + 12 * np.sqrt(width) + 24))
    chances = np.cumsum(np.exp(np.r_[0.0, np.cumsum(np.log(width / steps))] - width))  # of 0, 1, ... darts at most
    seed = _mix(elements * _MULT[0] + np.uint64(salt))
    darts = np.searchsorted(chances, _unit(seed), side="right")
    at = np.repeat(np.arange(len(elements)), darts)
    number = (np.arange(len(at)) - np.repeat(np.cumsum(darts) - darts, darts)).astype(np.uint64)
    dart = _mix(seed[at] + (number + np.uint64(1)) * _MULT[1])
    return at, (dart % np.uint64(k)).astype(np.int64), low + width * _unit(_mix(dart + _MULT[2]))


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], k: int = COORDINATES) -> np.ndarray:
    """One row per weighted set: at each coordinate a hash of its earliest dart.

    A whole weight w stands for w regions of unit weight: copy 1 to copy w of the element.
    A set without elements has a row of zeros.
    """
    sizes = np.array([int(w.sum()) for _, w in sets], np.int64)
    out = np.zeros((len(sets), k), np.uint64)
    if not sizes.sum():
        return out
    weights = np.concatenate([w for _, w in sets])
    elements = np.repeat(np.concatenate([e for e, _ in sets]), weights)
    copy = np.arange(len(elements)) - np.repeat(np.cumsum(weights) - weights, weights)
    elements = np.where(copy > 0, _mix(elements + copy.astype(np.uint64) * _MULT[2]), elements)
    owner = np.repeat(np.arange(len(sets)), sizes)
    ranks = np.full((len(sets), k), np.inf)
    low, level = 0.0, LOWEST
    open_ = sizes > 0
    while open_.any():
        high = 2.0 ** level
        at = np.flatnonzero(open_[owner])
        index, coordinate, rank = _throw(elements[at], low, high, level + 4096, k)
        if len(index):
            cell = owner[at[index]] * k + coordinate
            value = _mix(elements[at[index]] + (rank * 2.0 ** 40).astype(np.uint64) * _MULT[0])
            order = np.lexsort((value, rank, cell))
            cell, rank, value = cell[order], rank[order], value[order]
            first = np.r_[True, cell[1:] != cell[:-1]]
            cell, rank, value = cell[first], rank[first], value[first]
            better = rank < ranks.ravel()[cell]
            ranks.ravel()[cell[better]], out.ravel()[cell[better]] = rank[better], value[better]
        open_ &= ~np.isfinite(ranks).all(1)  # intervals rise, so nothing betters a full row later
        low, level = high, level + 1
    return out


def _weights(counts: np.ndarray, weighting: str) -> np.ndarray:
    return counts if weighting == "count" else np.ones_like(counts)


def sign(texts: DataFrame, k: int = COORDINATES, band_rows: int = BAND_ROWS, words: int = WORDS, weighting: str = "binary") -> DataFrame:
    """(id, th1, th2, bands): a hash per band of each text's signature; null for texts without words."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold_cache("dartminhash", _WORD_HASHES.clear)
        for batch in batches:
            for lo, hi in slices([len(t) for t in batch["text"]], BATCH_CHARS):
                part = batch.iloc[lo:hi]
                sets = [(e, _weights(n, weighting)) for e, n in (shingles(t, words) for t in part["text"])]
                rows = signatures(sets, k)
                bands = rows[:, : k // band_rows * band_rows].reshape(len(rows), -1, band_rows)
                h = np.broadcast_to(np.arange(bands.shape[1], dtype=np.uint64), bands.shape[:2])
                for i in range(band_rows):
                    h = _mix(h * _MULT[0] + bands[:, :, i])
                h = h.view(np.int64)
                yield pd.DataFrame({"id": part["id"], "th1": part["th1"], "th2": part["th2"], "bands": [x if len(e) else None for x, (e, _) in zip(h, sets)]})

    return texts.mapInPandas(apply, "id long, th1 long, th2 long, bands array<long>")


def shingle_sets(texts: DataFrame, words: int = WORDS, weighting: str = "binary") -> DataFrame:
    """(id, elements, counts, bits) of (id, text); ``bits`` marks, of ``SKETCH_BITS`` places, those that an element's hash falls on."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold_cache("dartminhash", _WORD_HASHES.clear)
        for batch in batches:
            for lo, hi in slices([len(t) for t in batch["text"]], BATCH_CHARS):
                rows = [shingles(t, words) for t in batch["text"].iloc[lo:hi]]
                yield pd.DataFrame({"id": batch["id"].iloc[lo:hi].to_numpy(), "elements": [e.view(np.int64) for e, _ in rows], "counts": [_weights(n, weighting).astype(np.int32) for _, n in rows], "bits": [sketch(e) for e, _ in rows]})

    return texts.mapInPandas(cut, "id long, elements array<long>, counts array<int>, bits array<long>")


def sketch(elements: np.ndarray) -> np.ndarray:
    """A bit for each place of ``SKETCH_BITS`` that an element falls on, in longs."""
    places = np.zeros(SKETCH_BITS, np.uint8)
    places[elements % np.uint64(SKETCH_BITS)] = 1
    return np.packbits(places, bitorder="little").view("<i8")


def _beyond(a: str, b: str) -> Column:
    """How many places of one sketch are not of the other: so many elements at least are in no intersection."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))), F.lit(0), lambda s, x: s + x)


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, similarity) of pairs of ids, exact on their shingle sets."""
    a = sets.select(F.col("id").alias("a"), F.col("elements").alias("ea"), F.col("counts").alias("ca"))
    b = sets.select(F.col("id").alias("b"), F.col("elements").alias("eb"), F.col("counts").alias("cb"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold_cache("similarities", dict)
        for batch in batches:
            found = []
            for ea, ca, eb, cb in zip(batch["ea"], batch["ca"], batch["eb"], batch["cb"]):
                elements, at = np.unique(np.concatenate((ea, eb)), return_inverse=True)
                wa, wb = np.bincount(at[:len(ea)], ca, len(elements)), np.bincount(at[len(ea):], cb, len(elements))
                found.append(float(np.minimum(wa, wb).sum() / max(1.0, np.maximum(wa, wb).sum())))
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": found})

    return pairs.join(a, "a").join(b, "b").mapInPandas(compare, "a long, b long, similarity double")


def components(edges: DataFrame) -> DataFrame:
    """(id, root): the least id of each node's connected component, by hooking and pointer jumping.

    Every round a node takes the least root among its neighbours' and hooks its own root to it;
    rounds go on until no root changes.  Each round's state is a table in the shared folder.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), "edges")
    state = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("root")).withColumnRenamed("a", "id"), "roots")
    while True:
        near = both.join(state.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("root").alias("least")).withColumnRenamed("a", "id")
        step = state.join(near, "id").select("id", "root", F.least("root", "least").alias("least"))
        hooks = step.groupBy(F.col("root").alias("id")).agg(F.min("least").alias("hook"))  # what a root's members found
        step = step.join(hooks.withColumnRenamed("id", "root"), "root").select("id", F.col("root").alias("old"), F.least("least", "hook").alias("root"))
        step = materialize(step, "hooked")
        jump = step.select(F.col("id").alias("root"), F.col("root").alias("up"))
        after = materialize(step.join(jump, "root", "left").select("id", "old", F.least("root", F.coalesce("up", "root")).alias("root")), "roots")
        if not after.filter("root <> old").limit(1).count():
            return after.select("id", "root")
        state = after.select("id", "root")


def _possible(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The rows (key, id, ...) of bucket members that can have a partner in their bucket at all, with their weight n, the weight ``shared`` and their sketch.

    Of a set's weight n, let u lie in elements that no other member of any bucket has.  A
    partner of weight s shares n - u at most, so the similarity is at most (n - u) / n if
    s may be n - u or less, else (n - u) / (s + u) for the bucket's least s.
    """
    ids = members.select("id").distinct()
    parts = sets.join(ids, "id", "left_semi").select("id", F.explode(F.arrays_zip("elements", "counts")).alias("x")).select("id", "x.elements", "x.counts")
    own = parts.groupBy("elements").agg(F.count("*").alias("n"), F.first("id").alias("id"), F.first("counts").alias("w")).filter("n = 1")
    unique = own.groupBy("id").agg(F.sum("w").alias("u"))
    weights = sets.select("id", "bits", F.aggregate("counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("n"))
    rows = members.join(weights, "id").join(unique, "id", "left").withColumn("u", F.coalesce("u", F.lit(0).cast("long")))
    least = rows.groupBy("key").agg(F.min("n").alias("least"))
    shared = F.col("n") - F.col("u")
    bound = F.when(F.col("least") <= shared, shared / F.col("n")).otherwise(shared / (F.col("least") + F.col("u")))
    return rows.join(least, "key").filter(bound >= threshold - 1e-9).select(*members.columns, "n", shared.alias("shared"), "bits")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, words: int = WORDS,
                    k: int = COORDINATES, band_rows: int = BAND_ROWS, weighting: str = "binary") -> DataFrame:
    """(id, class_id, text_id, n_links, n_rows): the least id of the document's class, the least id of its equal texts,
    the rows with this id, and the verified links of its text to other texts (those found by the two rounds).  ``weighting`` is
    ``binary`` (shingle sets) or ``count`` (how often each shingle occurs)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id IS NOT NULL")
    keyed = rows.withColumns({"th1": F.xxhash64("text"), "th2": F.xxhash64(F.lit(7), "text")})
    text = F.struct("th1", "th2", F.col("text").isNull().alias("void"))
    # equal texts: their least id stands for them; a null text only for itself
    members = keyed.groupBy("id").agg(F.min(text).alias("t"), F.count("*").alias("n_rows")).select("id", "t.*", "n_rows").withColumn("alone", F.when(F.col("void"), F.col("id")))
    members = materialize(members, "members")
    least = members.groupBy("th1", "th2", "alone").agg(F.min("id").alias("text_id"))
    texts_of = members.alias("m").join(least.alias("l"), F.expr("m.th1 = l.th1 AND m.th2 = l.th2 AND m.alone <=> l.alone"))
    texts_of = materialize(texts_of.select("m.id", "m.th1", "m.th2", "m.void", "m.n_rows", "l.text_id"), "text-classes")
    heads = texts_of.filter("id = text_id AND NOT void").select("id", "th1", "th2")
    keyed = keyed.filter("text IS NOT NULL")
    bands = sign(keyed, k, band_rows, words, weighting).filter("bands IS NOT NULL").join(heads, ["id", "th1", "th2"], "left_semi")
    signed = bands.groupBy("id").agg(F.first("bands").alias("bands")).select("id", F.posexplode("bands").alias("band", "key"))
    signed = materialize(signed.select("id", F.xxhash64("band", "key").alias("key")), "bands")
    firsts = signed.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("last")).filter("pivot <> last").select("key", "pivot")
    firsts = materialize(firsts, "shared-bands")
    buckets = materialize(keep_keyed(signed, [F.col("key")], firsts.select("key")).join(firsts, "key").select("key", "pivot", "id"), "buckets")
    stars = materialize(buckets.filter("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct(), "star-pairs")

    wanted = materialize(buckets.select("id").distinct().join(heads, "id"), "wanted")
    texts = keep_keyed(keyed, [F.col("id")], wanted.select("id")).join(wanted, ["id", "th1", "th2"], "left_semi")
    sets = materialize(shingle_sets(texts.dropDuplicates(["id"]).select("id", "text"), words, weighting), "shingle-sets")
    measured = materialize(similarities(stars, sets), "similarities")
    links = measured.filter(F.col("similarity") >= threshold)
    placed = (buckets.join(measured.select(F.col("a").alias("pivot"), F.col("b").alias("id"), "similarity"), ["pivot", "id"], "left")
              .join(components(links), "id", "left")
              .select("key", "pivot", "id", F.coalesce("root", "id").alias("root"), F.coalesce(F.col("similarity"), F.lit(1.0)).alias("near")))
    split = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("key")
    far = 1 - threshold
    # the first document of a bucket has met the others, so it goes
    open_ = materialize(placed.join(split, "key", "left_semi").filter("id <> pivot").drop("pivot"), "open-buckets")
    open_ = materialize(_possible(open_, sets, threshold).withColumn("zone", F.floor(F.col("near") / far)), "possible")
    # every pair meets in the least of its buckets alone: what that bucket rules out is out in all
    places = materialize(open_.groupBy("id").agg(F.sort_array(F.collect_set("key")).alias("keys")), "bucket-keys")  # one key a band at most
    open_ = open_.join(places, "id")
    # a document near the first has its class already, so one side is always a stranger to it
    left = (open_.filter(F.col("near") < threshold).withColumn("zone", F.explode(F.array(F.col("zone") - 1, F.col("zone"), F.col("zone") + 1)))
            .select("key", "zone", F.col("id").alias("x"), F.col("root").alias("rx"), F.col("near").alias("nx"), F.col("n").alias("wx"), F.col("shared").alias("sx"), F.col("keys").alias("kx"), F.col("bits").alias("bx")))
    right = open_.select("key", "zone", F.col("id").alias("y"), F.col("root").alias("ry"), F.col("near").alias("ny"), F.col("n").alias("wy"), F.col("shared").alias("sy"), F.col("keys").alias("ky"), F.col("bits").alias("by"))
    apart = (F.col("rx") != F.col("ry")) & (F.abs(F.col("nx") - F.col("ny")) <= far + 1e-9)
    apart &= (F.col("ny") >= threshold) | (F.col("x") < F.col("y"))  # two strangers meet from either side
    common = F.least("sx", "sy")  # what no other document has is in no intersection
    apart &= common >= (threshold - 1e-9) * (F.col("wx") + F.col("wy") - common)
    apart &= F.array_min(F.array_intersect("kx", "ky")) == F.col("key")
    common = F.least(F.col("wx") - _beyond("bx", "by"), F.col("wy") - _beyond("by", "bx"))
    apart &= common >= (threshold - 1e-9) * (F.col("wx") + F.col("wy") - common)
    strangers = left.join(right, ["key", "zone"]).filter(apart).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    strangers = materialize(strangers.join(measured.select("a", "b"), ["a", "b"], "left_anti"), "strangers")
    if strangers.limit(1).count():
        links = links.unionByName(similarities(strangers, sets).filter(F.col("similarity") >= threshold))
    links = materialize(links, "links")
    degree = links.select(F.explode(F.array("a", "b")).alias("text_id")).groupBy("text_id").agg(F.count("*").alias("n_links"))
    return (texts_of.join(components(links).withColumnRenamed("id", "text_id"), "text_id", "left").join(degree, "text_id", "left")
            .select("id", F.coalesce("root", "text_id").alias("class_id"), "text_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "n_rows"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each class, that of the least id, and one row of each id; rows without an id stay."""
    classes = materialize(near_duplicates(docs, id_col, text_col), "classes")
    later = classes.filter("id <> class_id").select("id")
    touched = classes.filter("id <> class_id OR n_rows > 1").select("id")
    mark, order = scratch_column(docs, "row_place"), Window.partitionBy(id_col).orderBy(F.xxhash64(text_col))
    test = key_test(touched)
    some = docs if test is None else docs.filter(test(F.col(id_col).cast("long")))
    rest = docs.filter(F.col(id_col).isNull()) if test is None else docs.filter(~test(F.col(id_col).cast("long")))
    some = (some.filter(F.col(id_col).isNotNull()).join(later.withColumnRenamed("id", mark), F.col(id_col) == F.col(mark), "left_anti")
            .withColumn(mark, F.row_number().over(order)).filter(F.col(mark) == 1).drop(mark))
    return some.unionByName(rest)
