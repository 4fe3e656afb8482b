"""Column-level cleaning of raw public-records fields.

Every function here maps ``Column`` to ``Column``; nothing runs in Python per
row.  Bad input turns into SQL null (``try_*`` functions) instead of failing
the job, which matters under ANSI mode where plain ``cast`` throws.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the source data's conventions.
# Violation-county code -> borough id (1 Manhattan, 2 Bronx, 3 Brooklyn,
# 4 Queens, 5 Staten Island).  Keys are matched exactly (case-sensitive).
COUNTY_CODES = {
    "MAN": 1, "MH": 1, "MN": 1, "NEWY": 1, "NEW Y": 1, "NY": 1,
    "BRONX": 2, "BX": 2,
    "BK": 3, "K": 3, "KING": 3, "KINGS": 3,
    "Q": 4, "QN": 4, "QNS": 4, "QU": 4, "QUEEN": 4,
    "R": 5, "RICHMOND": 5,
}
# Accepted house-number shape after trimming: digits, optionally one run of
# blanks/hyphens and more digits.  ``\z`` so a trailing newline is rejected.
HOUSE_NUMBER_PATTERN = r"^[0-9]+([ -]+[0-9]+)?\z"
HOUSE_NUMBER_GROUPS = r"^([0-9]+)(?:[ -]+([0-9]+))?\z"
# Date formats tried in order by the lenient year parser.
LENIENT_DATE_FORMATS = ("M/d/yyyy", "yyyy-MM-dd", "yyyy/M/d", "M-d-yyyy",
                        "yyyy-MM-dd HH:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss",
                        "MMM d yyyy", "MMM d, yyyy")
# Month names, each also by its first three letters ("sept" as well).
MONTH_NAMES = ("january", "february", "march", "april", "may", "june", "july", "august",
               "september", "october", "november", "december")
WEEKDAY_NAMES = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
# ---------------------------------------------------------------------------

# Classes of a date text's tokens, one letter each: n number of one or two digits, y of four,
# e of eight, x other numbers, M month, W weekday, P am/pm, T before a time, Z zone, O ordinal
# ending, U anything else; a mark stands for itself.
_TIME = "(,?T?(n:n(:n([.,][nyex])?)?P?|nP)(Z|[-+](n:n|y|n))?)?"
_DATES = ("y[-/.]n[-/.]n", "n[-/.]n[-/.][ny]", "nO?[-/.]?M[.]?,?[-/.]?[ny]", "M[.]?[-/]?nO?,?[-/]?[ny]", "y[-/.]?M[.]?[-/.]?n", "e")
DATE_SIGNATURE = f"^(W[.]?,?)?({'|'.join(_DATES)}){_TIME}$"

HOUSE_MODES = ("pair", "concat_text", "concat_int")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def upper(c: Column | str) -> Column:
    """Upper-case a name column."""
    return F.upper(_col(c))


def safe_int(c: Column | str) -> Column:
    """String -> int, null when it does not parse or overflows."""
    return _col(c).cast("string").try_cast("int")


def safe_double(c: Column | str) -> Column:
    """String -> double, null when it does not parse."""
    return _col(c).cast("string").try_cast("double")


def code_lookup(c: Column | str, mapping: dict | None = None) -> Column:
    """P5: exact-match code -> id via a literal map; unknown code -> null.

    The map is a literal in the plan (no join, no Python), evaluated inside
    whole-stage codegen.
    """
    mapping = COUNTY_CODES if mapping is None else mapping
    pairs = ", ".join(f"'{_sql_str(k)}', {int(v)}" for k, v in mapping.items())
    return F.try_element_at(F.expr(f"map({pairs})"), _col(c))


def _sql_str(v: str) -> str:
    return str(v).replace("\\", "\\\\").replace("'", "\\'")


def year_from_text(c: Column | str, fmt: str = "M/d/yyyy") -> Column:
    """Year of a date string in one fixed format; bad text -> null.

    ``M/d`` accepts one or two digits, so ``1/5/2017`` and ``01/05/2017``
    both parse; ``13/45/2017`` gives null.
    """
    return F.year(F.try_to_timestamp(_col(c), F.lit(fmt)))


def year_lenient(c: Column | str, formats: Sequence[str] = LENIENT_DATE_FORMATS) -> Column:
    """Year from the first of several formats that parses."""
    return F.year(F.coalesce(*[F.try_to_timestamp(_col(c), F.lit(f)) for f in formats]))


def _sql_map(pairs: dict) -> str:
    return "map(" + ", ".join(f"'{k}', {v!r}" for k, v in pairs.items()) + ")"


def _let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def date_fields(c: str) -> Column:
    """``struct<year, month, day>`` of a column of date text of any usual shape; other text -> null.

    One pass cuts the text into numbers, words and marks and classes each; the classes in order
    must be a date, after a weekday if any and before a time if any, and say which number is
    which.  Read are year first (``2017-05-01``, ``2017/5/1``, ``20170501``), numbers ending in
    the year (``1/5/2017``, ``1.5.17``), and month names before or after the day (``5 Jan 2017``,
    ``January 5th, 2017``, ``05-May-17``), with times like ``T10:00``, ``10:00:30.5 PM``, ``10 pm``
    and a zone behind.  Of two numbers before the year the first is the month, unless it is over
    12 and the second is not.  Years of two digits: 00-68 are 2000-2068, 69-99 are 1969-1999.
    The day must exist in the calendar.  The text is read once, however many shapes there are.
    """
    months = {n: i for i, m in enumerate(MONTH_NAMES, 1) for n in (m, m[:3])} | {"sept": 9}
    words = {m: "M" for m in months} | {n: "W" for w in WEEKDAY_NAMES for n in (w, w[:3])}
    words |= {"t": "T", "at": "T", "z": "Z", "utc": "Z", "gmt": "Z", "am": "P", "pm": "P", "st": "O", "nd": "O", "rd": "O", "th": "O"}
    tokens = f"regexp_extract_all(lower(CAST(`{c}` AS STRING)), r'[a-z]+|[0-9]+|[^a-z0-9\\s]', 0)"
    classes = ("transform(_t, _w -> CASE WHEN _w >= '0' AND _w < ':' THEN element_at(array('n', 'n', 'x', 'y', 'x', 'x', 'x', 'e', 'x'), least(length(_w), 9)) "
               f"ELSE coalesce(try_element_at({_sql_map(words)}, _w), CASE WHEN _w IN ('-', '/', '.', ',', ':', '+') THEN _w ELSE 'U' END) END)")
    fields = ("transform(filter(sequence(0, size(_t) - 1), _i -> _k[_i] IN ('n', 'y', 'M', 'e')), _i -> named_struct('c', _k[_i], "
              f"'v', CASE WHEN _k[_i] = 'M' THEN try_element_at({_sql_map(months)}, _t[_i]) ELSE try_cast(_t[_i] AS INT) END))")
    ordered = ("CASE WHEN _f[0].c = 'e' THEN named_struct('y', CAST(_f[0].v DIV 10000 AS INT), 'm', CAST(_f[0].v DIV 100 % 100 AS INT), 'd', _f[0].v % 100) "
               "WHEN _f[0].c = 'y' THEN named_struct('y', _f[0].v, 'm', _f[1].v, 'd', _f[2].v) "
               "WHEN _f[1].c = 'M' OR _f[0].c = 'n' AND _f[0].v > 12 AND _f[1].v <= 12 THEN named_struct('y', _f[2].v, 'm', _f[1].v, 'd', _f[0].v) "
               "ELSE named_struct('y', _f[2].v, 'm', _f[0].v, 'd', _f[1].v) END")
    year = "CASE WHEN _f[0].c IN ('n', 'M') AND _f[2].c = 'n' THEN _o.y + CASE WHEN _o.y < 69 THEN 2000 ELSE 1900 END ELSE _o.y END"
    last = ("CASE WHEN _o.m IN (4, 6, 9, 11) THEN 30 WHEN _o.m <> 2 THEN 31 "
            "WHEN _y % 4 = 0 AND (_y % 100 <> 0 OR _y % 400 = 0) THEN 29 ELSE 28 END")
    real = f"CASE WHEN _y > 0 AND _o.m BETWEEN 1 AND 12 AND _o.d BETWEEN 1 AND {last} THEN named_struct('year', _y, 'month', _o.m, 'day', _o.d) END"
    dated = _let(fields, "_f", _let(ordered, "_o", _let(year, "_y", real)))
    return F.expr(_let(tokens, "_t", _let(classes, "_k", f"CASE WHEN array_join(_k, '') RLIKE '{DATE_SIGNATURE}' THEN {dated} END")))


def year_any(c: str) -> Column:
    """The year of a column of date text of any usual shape (see ``date_fields``).

    Month/day/year and ISO dates up to the 28th, the bulk of most columns, need one match and no
    calendar; the rest is read as ``date_fields`` does, with the same result.
    """
    day, year = "(0?[1-9]|1[0-9]|2[0-8])", "(?!0000)[0-9]{4}"
    text = F.col(c).cast("string")
    plain = text.rlike(f"^(0?[1-9]|1[0-2])/{day}/{year}\\z")
    iso = text.rlike(f"^{year}-(0?[1-9]|1[0-2])-{day}([T ][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}})?)?\\z")
    return (F.when(plain, F.right(text, F.lit(4)).cast("int")).when(iso, F.left(text, F.lit(4)).cast("int"))
            .otherwise(date_fields(c)["year"]))


def house_number_ok(c: Column | str) -> Column:
    """the trimmed text has an accepted house-number shape."""
    return F.trim(_col(c).cast("string")).rlike(HOUSE_NUMBER_PATTERN)


def parse_house_number(c: Column | str, mode: str = "pair") -> Column:
    """House-number text -> ``struct<block:int, number:int>``.

    mode ``concat_text``  separators removed as text: ``12-05`` -> (0, 1205)
    mode ``concat_int``   parts parsed, then glued:  ``12-05`` -> (0, 125)
    mode ``pair``         (first part iff two parts, last part): (12, 5)

    Input is trimmed; anything not matching ``HOUSE_NUMBER_PATTERN`` and any
    part that overflows ``int`` gives null for the whole value.
    """
    if mode not in HOUSE_MODES:
        raise ValueError(f"mode must be one of {HOUSE_MODES}, got {mode!r}")
    if isinstance(c, str):
        # Same expression as below, as SQL text: one call instead of dozens.
        return F.expr(house_number_sql(f"`{c}`", mode))
    s = F.trim(_col(c).cast("string"))
    # regexp_extract compiles its (literal) pattern once per task; a regex
    # ``split`` would recompile it for every row.  No match gives ''.
    first_txt = F.regexp_extract(s, HOUSE_NUMBER_GROUPS, 1)
    second_txt = F.regexp_extract(s, HOUSE_NUMBER_GROUPS, 2)
    two = second_txt != F.lit("")
    first = first_txt.try_cast("int")
    second = second_txt.try_cast("int")
    zero = F.lit(0)
    if mode == "concat_text":
        block, number = zero, F.concat(first_txt, second_txt).try_cast("int")
    elif mode == "concat_int":
        glued = F.concat(first.cast("string"),
                         F.when(two, second.cast("string")).otherwise(F.lit("")))
        block, number = zero, glued.try_cast("int")
    else:
        block = F.when(two, first).otherwise(zero)
        number = F.when(two, second).otherwise(first)
    value = F.struct(block.cast("int").alias("block"), number.cast("int").alias("number"))
    return F.when(block.isNotNull() & number.isNotNull(), value)


def house_number_sql(c_sql: str, mode: str = "pair") -> str:
    """SQL text of ``parse_house_number`` for the SQL expression ``c_sql``."""
    s = f"trim(CAST({c_sql} AS STRING))"
    pat = "r'" + HOUSE_NUMBER_GROUPS + "'"
    g1, g2 = f"regexp_extract({s}, {pat}, 1)", f"regexp_extract({s}, {pat}, 2)"
    two = f"({g2} <> '')"
    first, second = f"try_cast({g1} AS INT)", f"try_cast({g2} AS INT)"
    if mode == "concat_text":
        block, number = "0", f"try_cast(concat({g1}, {g2}) AS INT)"
    elif mode == "concat_int":
        glued = (f"concat(CAST({first} AS STRING), "
                 f"CASE WHEN {two} THEN CAST({second} AS STRING) ELSE '' END)")
        block, number = "0", f"try_cast({glued} AS INT)"
    else:
        block = f"CASE WHEN {two} THEN {first} ELSE 0 END"
        number = f"CASE WHEN {two} THEN {second} ELSE {first} END"
    return (f"CASE WHEN ({block}) IS NOT NULL AND ({number}) IS NOT NULL THEN "
            f"named_struct('block', CAST({block} AS INT), 'number', CAST({number} AS INT)) END")


def parity(n: Column | str, even: str = "even", odd: str = "odd") -> Column:
    """Parity label of an integer; null stays null."""
    n = _col(n)
    return F.when(n % 2 == 0, F.lit(even)).when(F.abs(n % 2) == 1, F.lit(odd))


def year_onehot(year: Column | str, years: Iterable[int]) -> list[Column]:
    """One 0/1 indicator column per year, named ``y<year>``."""
    year = _col(year)
    return [(year == F.lit(y)).cast("int").alias(f"y{y}") for y in years]


def year_window(first_year: int, n_years: int = 5) -> list[int]:
    return list(range(first_year, first_year + n_years))
