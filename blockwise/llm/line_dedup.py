"""Line de-duplication by a deletion-neighbourhood join (operator 3).

Two lines are alike if they are equal, or differ by one word put in, left out or
replaced (a word-level edit distance of ``1``) and have ``MIN_WORDS`` words or more.
A line is dropped wherever an equal or alike line comes earlier, in order of
(id, text hash, line number); the earliest stays.  With ``short_repeats`` exact repeats
of shorter lines are dropped by the same rule; the edit still needs ``MIN_WORDS`` words.

Every variant within the bound is a hashed key: a line with word p blanked (a
replacement), a line with word p deleted, and the line itself.  Lines that share a key
are within the bound, so each key's earliest line is the only partner a line needs: the
join is linear even for thousands of variants of one line, and no pair within a group
is emitted.  The partner is then verified on the words themselves.  Variants are made
only for lines that share a first or last half with another line, which alike lines
always do.

Nulls and edges: a null text stays null, an empty one empty; blank lines stay, and lines
under ``MIN_WORDS`` words too unless ``short_repeats`` is set; rows that repeat both id and text count as one document and
get the same result; a null id sorts first.  Work per line is linear in its words, so
very long lines need nothing special.  Columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep_keyed, key_test, materialize, scratch_column

MIN_WORDS = 5
REPLACE, DELETE, WHOLE = 0, 1, 2  # roles of a line at a key


def _spaced(text: Column) -> Column:
    """Text with one space for each stretch of spaces, tabs and carriage returns."""
    odd = F.contains(text, F.lit("  ")) | F.contains(text, F.lit("\t")) | F.contains(text, F.lit("\r"))
    return F.when(odd, F.regexp_replace(text, "[ \\t\\r]+", " ")).otherwise(text)


def _half(words: Column) -> Column:
    """The largest step (1, 2, 3, 4, 6, 8, 12, ...) up to half of so many words."""
    half = F.greatest(F.shiftright(words, 1), F.lit(1))
    low = F.call_function("shiftleft", F.lit(1), F.length(F.bin(half)) - 1)  # the power of two
    return F.when(half >= low + F.shiftright(low, 1), low + F.shiftright(low, 1)).otherwise(low)


def _half_keys(line: Column, own: Column, shorter: Column) -> Column:
    """Hashes of the first and last c words, for the largest step c <= n / 2 (``own``) and, where the
    step of n - 1 words (``shorter``) is another, for that too: lines within the bound share one of them."""
    def keys(c: Column) -> Column:
        return F.array(F.xxhash64(F.lit("first"), c, F.call_function("substring_index", line, F.lit(" "), c)),
                       F.xxhash64(F.lit("last"), c, F.call_function("substring_index", line, F.lit(" "), -c)))

    return F.when(own == shorter, keys(own)).otherwise(F.concat(keys(own), keys(shorter)))


def _lines(docs: DataFrame, short: bool = False) -> DataFrame:
    """(id, th, pos, line, n, h1, h2) of every line of ``MIN_WORDS`` words or more, with ``short`` of every line that is not blank; docs has (id, th, text)."""
    # normalised before they are parted: filters on a line would otherwise normalise it again each time they name it,
    # and so would Spark's own filter before a generator that is not outer; the null line of a null text goes below
    lines = docs.select("id", "th", F.posexplode_outer(F.transform(F.split(_spaced(F.col("text")), "\n"), lambda line: F.trim(line))).alias("pos", "line"))
    lines = lines.withColumn("n", F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1)
    return lines.filter(F.col("line") != "" if short else F.col("n") >= MIN_WORDS).withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(7), "line")})


def _alike(a: Column, b: Column) -> Column:
    """Word arrays within one edit: their common first and last words cover all but one of the longer."""
    def common(x: Column, y: Column) -> Column:
        first = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False)
        return F.when(first == 0, F.least(F.size(x), F.size(y))).otherwise(first - 1)

    longest = F.greatest(F.size(a), F.size(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (common(a, b) + common(F.reverse(a), F.reverse(b)) >= longest - 1)


def near_lines(lines: DataFrame, distinct: DataFrame) -> DataFrame:
    """(h1, h2) of the lines that have an earlier line one edit away.

    ``lines`` as of ``_lines``; ``distinct``: (h1, h2, first, copies, halves) of each distinct line; the halves of a short line are null.
    """
    shared = (distinct.select(F.explode("halves").alias("key"), "h1").groupBy("key")
              .agg(F.min("h1").alias("a"), F.max("h1").alias("b")).filter("a <> b").select("key"))
    halves = [F.get("halves", F.lit(i)) for i in range(4)]
    candidates = keep_keyed(distinct, halves, materialize(shared, "half-keys")).select("h1", "h2", "first").distinct()
    candidates = materialize(candidates, "line-candidates")
    texts = keep_keyed(lines.select("h1", "h2", "line"), [F.col("h1")], candidates.select("h1"))
    texts = texts.groupBy("h1", "h2").agg(F.first("line").alias("line")).join(candidates, ["h1", "h2"])
    texts = materialize(texts.withColumn("words", F.split("line", " ")).drop("line"), "candidate-lines")

    def total(shift: int) -> Column:
        terms = F.transform("words", lambda w, i: F.xxhash64(i - shift, w))
        return F.aggregate(terms, F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y))

    # dealt by line once; the words of a line then stay in its task
    words = (texts.select("first", F.size("words").alias("n"), total(0).alias("whole"), total(1).alias("shifted"), "words").repartition("first")
             .select("first", "n", "whole", "shifted", F.posexplode("words").alias("p", "word"))
             .select("first", "n", "whole", "shifted", "p", F.xxhash64("p", "word").alias("a"), F.xxhash64(F.col("p") - 1, "word").alias("b")))
    along = Window.partitionBy("first").orderBy("p")
    before = F.coalesce(F.bit_xor("a").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    until = F.bit_xor("b").over(along.rowsBetween(Window.unboundedPreceding, 0))
    variants = words.withColumns({"blanked": F.col("whole").bitwiseXOR(F.col("a")), "deleted": before.bitwiseXOR(F.col("shifted").bitwiseXOR(until))})
    # a line is known by its first place from here on
    keyed = variants.select("first", F.explode(F.array(
        F.struct(F.lit(REPLACE).alias("role"), F.xxhash64(F.lit("r"), "n", "p", "blanked").alias("key")),
        F.struct(F.lit(DELETE).alias("role"), F.xxhash64(F.lit("d"), F.col("n") - 1, "deleted").alias("key")))).alias("v")).select("first", "v.role", "v.key")
    wholes = texts.select("first", F.lit(WHOLE).alias("role"), F.xxhash64(F.lit("d"), F.size("words"), total(0)).alias("key"))
    keyed = materialize(keyed.unionByName(wholes), "line-variants")
    mark = F.xxhash64("first")
    met = (keyed.select("key", mark.alias("line")).groupBy("key").agg(F.min("line").alias("a"), F.max("line").alias("b")).filter("a <> b").select("key"))
    keyed = materialize(keep_keyed(keyed, [F.col("key")], materialize(met, "shared-variants")), "met-variants")

    def earliest(role: int) -> Column:
        return F.min(F.when(F.col("role") == role, F.col("first")))

    groups = keyed.groupBy("key").agg(earliest(REPLACE).alias("replaced"), earliest(DELETE).alias("deleted"), earliest(WHOLE).alias("whole"))
    partner = F.when(F.col("role") == REPLACE, F.col("replaced")).when(F.col("role") == DELETE, F.col("whole")).otherwise(F.col("deleted"))
    pairs = (keyed.join(groups, "key").select("first", partner.alias("partner")).filter(F.col("partner") < F.col("first"))
             .groupBy("first").agg(F.min("partner").alias("partner")))
    a, b = texts.select("h1", "h2", "first", F.col("words").alias("wa")), texts.select(F.col("first").alias("partner"), F.col("words").alias("wb"))
    return pairs.join(a, "first").join(b, "partner").filter(_alike(F.col("wa"), F.col("wb"))).select("h1", "h2")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = False, short_repeats: bool = False) -> DataFrame:
    """``docs`` with the lines dropped from ``text_col``, with ``short_repeats`` also exact repeats of short lines; with ``counts`` also n_lines and n_dropped (renamed on a clash)."""
    text = F.col(text_col)
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    lines = _lines(keyed.select("id", "th", "text"), short_repeats)
    place = F.struct("id", "th", "pos")
    halves = F.when(F.col("n") >= MIN_WORDS, _half_keys(F.col("line"), F.col("own"), F.col("shorter")))
    # columns of their own: Spark works out again what stands several times within a condition
    steps = lines.withColumns({"own": _half(F.col("n")), "shorter": _half(F.col("n") - 1)})
    # the texts are cut into lines once for all that hashes and places can answer
    places = materialize(steps.select("id", "th", "pos", "h1", "h2", halves.alias("halves")), "line-places")
    distinct = materialize(places.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("copies"), F.first("halves").alias("halves")), "distinct-lines")
    # candidates are known by their hashes, so their words need no count
    near = near_lines(_lines(keyed.select("id", "th", "text"), True), distinct).withColumn("near", F.lit(True))
    again = materialize(distinct.select("h1", "h2", "first", "copies").join(near, ["h1", "h2"], "left").filter("copies > 1 OR near"), "repeated-lines")
    seen = keep_keyed(places.select("id", "th", "pos", "h1", "h2"), [F.col("h1")], again.select("h1"))
    dropped = seen.join(again, ["h1", "h2"]).filter(F.col("near") | ~place.eqNullSafe(F.col("first")))
    drops = materialize(dropped.groupBy("id", "th").agg(F.collect_set("pos").alias("drop")), "dropped-lines")
    drops = drops.withColumn("mark", F.xxhash64("id", "th"))
    marked = keyed.withColumn("mark", F.xxhash64("id", "th"))
    found = drops.select(F.col("id").alias("i2"), F.col("th").alias("t2"), "drop")
    same = F.col("id").eqNullSafe(F.col("i2")) & (F.col("th") == F.col("t2"))
    test = key_test(drops.select("mark"))
    if test is None:
        whole = marked.join(found, same, "left").select("row", "text", "drop")
    else:  # documents without a dropped line pass by the join
        rest = marked.filter(~test(F.col("mark"))).select("row", "text", F.lit(None).cast("array<int>").alias("drop"))
        whole = marked.filter(test(F.col("mark"))).join(found, same, "left").select("row", "text", "drop").unionByName(rest)
    whole = whole.withColumn("split", F.split("text", "\n"))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("split") - 1), "drop"), lambda i: F.get("split", i))
    cleaned = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    out = [cleaned.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    if counts:
        out += [F.coalesce(F.size("split"), F.lit(0)).cast("long").alias(scratch_column(docs, "n_lines")), F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias(scratch_column(docs, "n_dropped"))]
    return whole.select(*out)
