"""Personal data by bootstrapped contextual extraction (operator 10).

Fixed patterns find e-mail addresses, IP addresses, card and phone numbers; these are
the seeds, each whole with its spaces.  Words outside them that look like identifiers
(they hold a digit or an @), with the digit groups that follow them, are the other
instances.  Instances and their one or two words to the left, of any length and whether
identifiers themselves or not, make a graph.  Rounds of scoring go
back and forth over it: a pattern's confidence is the share of all the words that follow
it in the corpus which are trusted instances, and an unseen instance is trusted as far
as its confident patterns make it.  Where a confident pattern with enough distinct seeds
stands before an unseen identifier, the identifier is reported as ``learned``.

Everything is DataFrame expressions: spans come from regular expressions anchored at the
end of the match before, and their places from running totals of lengths.

Nulls and edges: a null text is an empty text; rows that repeat both id and text are
one document in the statistics and each get the same spans; ties between kinds at one
start go by the kinds' order; texts of any length are searched whole, and no pattern
backtracks over a long run; an empty table gives no rows.  Columns of any name pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import key_test, keep_keyed, materialize

MIN_SEEDS = 5          # distinct seeds that a pattern needs
MIN_CONFIDENCE = 0.7   # share of trusted instances among all words that follow it
ROUNDS = 3
KINDS = ("email", "ip", "card", "phone", "learned")

#: kind: (what must stand before a match unless it follows the last one, the match, a cheap test of the text)
_PATTERNS = {
    "email": ("[^A-Za-z0-9._%+-]", "[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++", "@"),
    "ip": ("[^0-9]", "[0-9]++(?:\\.[0-9]++){3}", "[0-9]\\.[0-9]"),
    "card": ("", "[0-9](?:[ -]?[0-9]){13,}+", "[0-9](?:[ -]?[0-9]){13}"),
    "phone": ("", "\\+[0-9][ ().0-9-]+[0-9]", "\\+[0-9]"),
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often (or in whatever lambda) the body uses it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def running_total(lengths: Column, block: int = 128) -> Column:
    """Running sums of an array of ints, by blocks, so that the work is not square."""
    def add(a: Column) -> Column:
        return F.aggregate(a, F.lit(0), lambda s, x: s + x)

    def sums(a: Column) -> Column:
        count = F.floor((F.size(a) + block - 1) / block).cast("int")
        blocks = F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda b: add(F.slice(a, (b - 1) * block + 1, F.lit(block))))
        return let(blocks, lambda bs: let(
            F.transform(bs, lambda _, b: add(F.slice(bs, F.lit(1), b))),
            lambda bases: F.transform(a, lambda _, i: F.get(bases, F.floor(i / block).cast("int")) + add(F.slice(a, F.floor(i / block).cast("int") * block + 1, i % block + 1)))))

    return let(lengths, sums)


def _matches(text: Column, before: str, match: str) -> Column:
    """(start, end, gap, value) of the leftmost matches that do not overlap; gap: the text since the match before."""
    gap = f"(?:(?s:.*?){before})??" if before else "(?s:.*?)"
    whole = f"\\G({gap})({match})"
    both = F.zip_with(F.regexp_extract_all(text, F.lit(whole), F.lit(1)), F.regexp_extract_all(text, F.lit(whole), F.lit(2)),
                      lambda g, v: F.struct(g.alias("gap"), v.alias("value")))

    def place(ms: Column) -> Column:
        ends = running_total(F.transform(ms, lambda m: F.length(m["gap"]) + F.length(m["value"])))
        return F.zip_with(ms, ends, lambda m, e: F.struct((e - F.length(m["value"])).alias("start"), e.alias("end"), m["gap"].alias("gap"), m["value"].alias("value")))

    return let(both, place)


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    ds = F.reverse(F.split(digits, ""))
    each = F.transform(F.filter(ds, lambda d: d != ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.pmod(d.cast("int") * 2, F.lit(10)) + F.floor(d.cast("int") * 2 / 10).cast("int")))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, "\\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(p.substr(-3, 3).cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return (F.length(digits) >= 14) & (F.length(digits) <= 19) & _luhn(digits)
    if kind == "phone":
        return (F.length(digits) >= 10) & (F.length(digits) <= 15)
    return F.lit(True)


def _seed_value(kind: str, value: Column) -> Column:
    """One form of a seed, however it is written."""
    return F.regexp_replace(value, "[^0-9]", "") if kind in ("card", "phone") else F.lower(value)


def base_spans(text: Column, values: bool = False) -> Column:
    """Sorted array of (start, kind index, end) of the four fixed kinds; with ``values`` also the seed's value."""
    none = F.array().cast(f"array<struct<start:int,kind:int,end:int{',value:string' if values else ''}>>")

    def spans(k: int, kind: str) -> Column:
        before, match, test = _PATTERNS[kind]
        hits = F.filter(_matches(text, before, match), lambda m: _valid(kind, m["value"]))
        present = F.contains(text, F.lit(test)) if kind == "email" else F.rlike(text, F.lit(test))
        return F.when(present, F.transform(hits, lambda m: F.struct(
            m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end"), *[_seed_value(kind, m["value"]).alias("value")] * values))).otherwise(none)

    return F.array_sort(F.concat(*[spans(k, kind) for k, kind in enumerate(_PATTERNS)]))


def span_text(spans: Column) -> Column:
    """kind:start:end of sorted spans, joined by commas."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


#: A word with a digit or @, and the digit groups that follow a digit at its end by single spaces.
_IDENTIFIER = "[^\\s0-9@]*+[0-9@]\\S*+(?:(?<=[0-9]|[0-9]\\)) \\(?[0-9][0-9().-]*+[^\\p{L}\\p{N}\\s]*+(?!\\S))*+"


def _last_words(text: Column) -> Column:
    """The last two words of a text, lower-cased, with one space between."""
    return F.call_function("substring_index", F.trim(F.regexp_replace(F.lower(text), "\\s+", " ")), F.lit(" "), F.lit(-2))


def identifiers(text: Column) -> Column:
    """(start, word_end, end, value, left1, left2) of the words with a digit or @ and the digit groups after them, where a word
    stands to the left, itself an identifier or not; word_end: the end of the first word; left2 is null after a single word."""
    found = F.when(F.rlike(text, F.lit("[0-9@]")), _matches(text, "\\s", _IDENTIFIER))
    tails = F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), (m["start"] + F.length(F.substring_index(m["value"], " ", 1))).alias("word_end"), m["end"].alias("end"), m["value"].alias("value"),
        _last_words(m["gap"]).alias("gap"), _last_words(m["value"]).alias("last")))

    def runs(ms: Column) -> Column:
        def run(m: Column, i: Column) -> Column:
            # a match has a word at least, so two matches before reach back two words
            left = F.concat_ws(" ", F.get(ms, i - 2)["last"], F.get(ms, i - 1)["gap"], F.get(ms, i - 1)["last"], m["gap"])
            words = F.filter(F.split(left, " "), lambda w: w != "")
            return let(words, lambda ws: F.struct(
                m["start"].alias("start"), m["word_end"].alias("word_end"), m["end"].alias("end"), m["value"].alias("value"),
                F.try_element_at(ws, F.lit(-1)).alias("left1"),
                F.concat(F.try_element_at(ws, F.lit(-2)), F.lit(" "), F.try_element_at(ws, F.lit(-1))).alias("left2")))

        return F.transform(ms, run)

    return F.filter(let(tails, runs), lambda x: x["left1"].isNotNull())


def instance(x: Column, spans: Column) -> Column:
    """(seed, start, end, value) of one of the ``identifiers``, null if its first word is the rest of an earlier seed: the first seed that starts in its first word, or else the words up to the next seed, without punctuation around them."""
    def candidate(raw: Column) -> Column:
        lead = F.length(F.regexp_extract(raw, "^[^\\p{L}\\p{N}]*+", 0))
        core = F.regexp_replace(F.regexp_replace(raw, "^[^\\p{L}\\p{N}]++", ""), "[^\\p{L}\\p{N}]+$", "")

        def located(y: Column) -> Column:
            digits = F.regexp_replace(y["core"], "[ ().+-]", "")
            # a number as long as a phone's or card's has the seeds' form
            value = F.when(F.rlike(digits, F.lit("^[0-9]{10,}$")), digits).otherwise(F.lower(y["core"]))
            start = x["start"] + y["lead"]
            return F.when(y["core"] != "", F.struct(F.lit(False).alias("seed"), start.alias("start"), (start + F.length(y["core"])).alias("end"), value.alias("value")))

        return let(F.struct(core.alias("core"), lead.alias("lead")), located)

    def choose(mine: Column) -> Column:
        first = F.get(mine, F.lit(0))
        seed = F.get(F.filter(mine, lambda s: (s["start"] >= x["start"]) & (s["start"] < x["word_end"])), F.lit(0))
        upto = F.coalesce(first["start"] - x["start"], F.length(x["value"]))
        return (F.when(seed.isNotNull(), F.struct(F.lit(True).alias("seed"), seed["start"].alias("start"), seed["end"].alias("end"), seed["value"].alias("value")))
                .when(F.coalesce(first["start"] >= x["word_end"], F.lit(True)), candidate(F.left(x["value"], upto))))

    return let(F.filter(spans, lambda s: (s["start"] < x["end"]) & (s["end"] > x["start"])), choose)


def _pattern_totals(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, total): how often any word follows each of the ``patterns``, over all ``texts``."""
    words = texts.select(F.filter(F.split(F.lower("text"), "\\s+"), lambda w: w != "").alias("w"))
    # the last word has no word after it
    firsts = F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0)))
    ones = words.select(firsts.alias("w"))
    ones = ones.select(F.explode(F.concat("w", F.zip_with("w", F.slice("w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b)))).alias("pattern")).filter("pattern IS NOT NULL")
    kept = keep_keyed(ones.withColumn("key", F.xxhash64("pattern")), [F.col("key")], patterns.select(F.xxhash64("pattern").alias("key")))
    return kept.groupBy("pattern").agg(F.count("*").alias("total")).join(patterns, "pattern", "left_semi")


def confident_patterns(texts: DataFrame, instances: DataFrame, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, confidence) of the patterns to trust.

    ``instances``: (value, seed, left1, left2) of each identifier, ``texts``: (text) of each document.
    """
    edges = (instances.select("value", "seed", F.explode(F.array("left1", "left2")).alias("pattern"))
             .groupBy("pattern", "value").agg(F.count("*").alias("n"), F.max("seed").alias("seed")))
    edges = materialize(edges.filter("pattern IS NOT NULL"), "pattern-instances")
    supported = materialize(edges.filter("seed").groupBy("pattern").agg(F.count("*").alias("seeds")).filter(F.col("seeds") >= min_seeds).select("pattern"), "patterns")
    none = supported.limit(0).withColumn("confidence", F.lit(0.0))
    if not supported.limit(1).count():
        return none
    totals = materialize(_pattern_totals(texts, supported), "pattern-totals")
    edges = materialize(edges.join(totals, "pattern"), "supported-edges")
    # a value that is a seed anywhere is trusted everywhere
    trust = edges.groupBy("value").agg(F.max("seed").cast("double").alias("trust"))
    scores = none
    for _ in range(rounds):
        # words of a context that ends a text or is cut count once at least, so the share stays below 1
        scores = (edges.join(trust, "value").groupBy("pattern").agg((F.sum(F.col("n") * F.col("trust")) / F.greatest(F.max("total"), F.sum("n"))).alias("confidence"))
                  .filter(F.col("confidence") >= min_confidence))
        scores = materialize(scores, "pattern-scores")
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.coalesce("confidence", F.lit(0.0)), F.lit(1e-9)))))
        trust = (edges.join(scores, "pattern", "left").groupBy("value")
                 .agg(F.max("seed").alias("seed"), doubt.alias("doubt"))
                 .select("value", F.when(F.col("seed"), 1.0).otherwise(1 - F.coalesce("doubt", F.lit(1.0))).alias("trust")))
        trust = materialize(trust, "instance-scores")
    return scores


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """(id, th, base spans) of every row, and (id, th, learned spans) of the documents that have any; th: hash of the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    # both extractions in one scan; only places and short values are stored
    base = materialize(rows.select("id", "th", base_spans(F.col("text"), values=True).alias("base"), identifiers(F.col("text")).alias("ids")), "pii-spans")
    each = (base.filter(F.size("ids") > 0).dropDuplicates(["id", "th"])
            .select("id", "th", "base", F.explode("ids").alias("x"))
            .select("id", "th", instance(F.col("x"), F.col("base")).alias("i"), "x.left1", "x.left2").filter("i IS NOT NULL")
            .select("id", "th", "i.*", "left1", "left2"))
    each = materialize(each, "pii-instances")
    trusted = confident_patterns(rows.select("id", "th", "text"), each, min_seeds, min_confidence)
    unseen = each.filter("NOT seed").withColumn("pattern", F.explode(F.array("left1", "left2")))
    learned = (unseen.join(trusted, "pattern", "left_semi")
               .groupBy("id", "th").agg(F.array_sort(F.collect_set(F.struct("start", F.lit(4).alias("kind"), "end"))).alias("learned")))
    places = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return base.select("id", "th", places.alias("base")), materialize(learned, "pii-learned")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, n_learned, base_sha256, spans) of every row."""
    base, learned = find(docs, id_col, text_col)
    found = learned.select(F.col("id").alias("i2"), F.col("th").alias("t2"), "learned")
    rows = base.join(found, F.col("id").eqNullSafe(F.col("i2")) & (F.col("th") == F.col("t2")), "left")
    everything = F.array_sort(F.concat("base", F.coalesce("learned", F.array().cast("array<struct<start:int,kind:int,end:int>>"))))

    def count(k: int) -> Column:
        return F.size(F.filter("all", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return rows.select("id", "base", everything.alias("all")).select(
        "id", *[count(k) for k in range(len(KINDS))], F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("all")).alias("spans"))


def mask(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlapping spans are one, of the first's kind."""
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def add(kept: Column, s: Column) -> Column:
        last = F.try_element_at(kept, F.lit(-1))
        union = F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(F.coalesce(last["end"], F.lit(0)) <= s["start"], F.concat(kept, F.array(s))).otherwise(F.concat(F.slice(kept, F.lit(1), F.size(kept) - 1), F.array(union)))

    apart = F.aggregate(spans, empty, add)
    name = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def rebuild(spans_: Column) -> Column:
        def until(i: Column) -> Column:
            return F.coalesce(F.get(spans_, i - 1)["end"], F.lit(0))

        pieces = F.transform(spans_, lambda s, i: F.concat(F.call_function("substring", text, until(i) + 1, s["start"] - until(i)), F.get(name, s["kind"])))
        return F.concat(F.array_join(pieces, ""), F.call_function("substring", text, until(F.size(spans_)) + 1, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(let(apart, rebuild))


def mask_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all spans of ``text_col`` masked; a null text stays null."""
    _, learned = find(docs, id_col, text_col)
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), F.col(text_col).alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("id", "th"))
    found = learned.select(F.col("id").alias("i2"), F.col("th").alias("t2"), "learned")
    same = F.col("id").eqNullSafe(F.col("i2")) & (F.col("th") == F.col("t2"))
    test = key_test(learned.select(F.xxhash64("id", "th").alias("mark")))
    if test is None:
        rows = rows.join(found, same, "left").select("row", "text", F.coalesce("learned", none).alias("learned"))
    else:
        rest = rows.filter(~test(F.col("mark"))).select("row", "text", none.alias("learned"))
        rows = rows.filter(test(F.col("mark"))).join(found, same, "left").select("row", "text", F.coalesce("learned", none).alias("learned")).unionByName(rest)
    rows = rows.select("row", "text", F.array_sort(F.concat(base_spans(F.col("text")), "learned")).alias("spans"))
    masked = F.when(F.col("text").isNotNull(), mask(F.col("text"), F.col("spans")))
    return rows.select(*[masked.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
