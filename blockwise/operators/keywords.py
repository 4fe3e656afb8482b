"""Term matching on whole texts and per-zone rates.

Tokens are the pieces of the text split on a single space: empty tokens are
kept (so a blank term matches a double space), no case folding, no
punctuation stripping, and a multi-word term never matches.  Every text is
tokenised whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockwise.operators.bloom import bloom_test
from blockwise.operators.sizing import DEFAULT_BROADCAST_ROWS, maybe_broadcast
from blockwise.scratch import stored

# Terms of a frame are inlined as literals up to this many bytes in total; beyond
# it (or when a term list grows with the data) texts meet them in a join.
MAX_INLINE_BYTES = 1 << 20


def tokens(text: Column | str, sep: str = " ") -> Column:
    """Split on a literal single separator, keeping empty tokens."""
    text = F.col(text) if isinstance(text, str) else text
    return F.split(text, _regex_literal(sep), -1)


def _regex_literal(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in s)


def has_any_term(text: Column | str, terms: Sequence[str]) -> Column:
    """The token set of ``text`` shares at least one element with ``terms``.

    One form for every length: each token is looked up in the set of terms.
    """
    text = F.col(text) if isinstance(text, str) else text
    known = [F.lit(t) for t in dict.fromkeys(terms)]
    if not known:
        return F.when(text.isNotNull(), F.lit(False))
    return F.exists(tokens(text), lambda t: t.isin(known))


def terms_from_frame(terms: DataFrame, col: str | None = None,
                     max_bytes: int = MAX_INLINE_BYTES) -> list[str] | None:
    """The distinct terms of a one-column frame, or None when they exceed ``max_bytes``."""
    col = col or terms.columns[0]
    distinct = terms.select(F.col(col).alias("term")).where(F.col(col).isNotNull()).distinct()
    size = distinct.agg(F.sum(F.octet_length("term") + 8)).first()[0] or 0
    return [r[0] for r in distinct.collect()] if size <= max_bytes else None


def keyword_filter(df: DataFrame, text: str, terms: Sequence[str] | DataFrame,
                   max_bytes: int = MAX_INLINE_BYTES) -> DataFrame:
    """Rows whose text contains at least one term.

    Literal terms and frames up to ``max_bytes`` are looked up in place (no
    shuffle).  A longer frame is joined: the distinct tokens of each text that pass a
    Bloom filter of the terms meet the terms, and rows keep by the hash pair of their text.
    """
    if isinstance(terms, DataFrame):
        inline = terms_from_frame(terms, max_bytes=max_bytes)
        if inline is None:
            return _keyword_join(df, text, terms)
        terms = inline
    return df.where(has_any_term(F.col(text), terms))


def _keyword_join(df: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """``keyword_filter`` for term frames of any size.

    A Bloom filter of the terms is tested in the scan, so the tokens that are shuffled are
    the hits and the filter's few errors; the join that follows is exact.
    """
    taken = {c.lower() for c in df.columns}
    h1, h2 = (next(n for n in (f"{p}{'_' * k}" for k in range(1, 99)) if n not in taken) for p in ("th1", "th2"))
    hashes = {h1: F.xxhash64(F.col(text)), h2: F.xxhash64(F.lit(7), F.col(text))}
    t = stored(terms.select(F.col(terms.columns[0]).alias("_term")).where("_term IS NOT NULL").distinct(), "terms")
    hits = (candidate_tokens(df, text, hashes, t).join(t, "_term", "left_semi").select(h1, h2).distinct())
    return df.withColumns(hashes).join(hits, [h1, h2], "left_semi").select(*df.columns)


def candidate_tokens(df: DataFrame, text: str, keys: dict[str, Column], terms: DataFrame) -> DataFrame:
    """(``_term``, keys) of the distinct tokens of each text that pass the Bloom filter of ``terms``."""
    # the keys are computed once a text, below the explode; the text itself ends there
    each = df.where(F.col(text).isNotNull()).select(
        *[c.alias(n) for n, c in keys.items()], F.array_distinct(tokens(F.col(text))).alias("_tokens"))
    found = each.select(*keys, F.explode("_tokens").alias("_term"))
    return found.where(bloom_test(terms)(F.col("_term")))


def keyword_semi_join(df: DataFrame, text: str, terms: DataFrame, keep: Sequence[str],
                      term_col: str | None = None,
                      broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """J6 as a relational semi-join: distinct ``keep`` rows of texts with a hit.

    For short lists ``keyword_filter`` is cheaper, since it emits no token rows.
    Distinct tokens of each text are exploded next to the ``keep`` columns only (never the text),
    semi-joined with the term list (broadcast after a size check), and
    de-duplicated: the shuffle carries hit tokens' small columns, with
    map-side de-duplication first.  ``keep`` must identify a text (an id).
    """
    term_col = term_col or terms.columns[0]
    t = terms.select(F.col(term_col).alias("_term")).where(F.col("_term").isNotNull()).distinct()
    t, _ = maybe_broadcast(t, broadcast_rows)
    tok = df.select(*keep, F.explode(F.array_distinct(tokens(F.col(text)))).alias("_tok"))
    hits = tok.join(t, tok["_tok"] == t["_term"], "left_semi")
    return hits.select(*keep).dropDuplicates(list(keep))


def union_terms(*lists: DataFrame) -> DataFrame:
    """Concatenate word lists (one ``value`` column each)."""
    out = lists[0]
    for other in lists[1:]:
        out = out.unionByName(other)
    return out


def zone_rate(counts: DataFrame, population: DataFrame, *, key: str = "zone_id",
              n: str = "n", pop: str = "population", out: str = "rate") -> DataFrame:
    """Count / population per zone; population 0 or missing -> null.

    Both inputs are per-zone aggregates, so no explicit broadcast: AQE sees
    the measured size of both (small) shuffles and picks the join at run time.
    """
    j = counts.join(population.select(key, pop), key, "left")
    return j.select(key, n, pop, F.try_divide(F.col(n).cast("double"),
                                              F.col(pop).cast("double")).alias(out))
