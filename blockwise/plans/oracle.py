"""DuckDB oracle SQL for every catalogue query.

Written directly in SQL against the driver's tables (record-level joins, no
pre-aggregation, plain even-odd polygon test) so it checks the Spark plans
independently.  Only fixed values (code table, recipe constants, projection
constants) are shared with the Spark side.
"""

from __future__ import annotations

import math

from blockwise.functions.geometry import lcc_constants
from blockwise.functions.normalize import COUNTY_CODES, year_window
from blockwise.sources.tables import PENTAGON, RECORD_FIRST_YEAR

YEARS = year_window(RECORD_FIRST_YEAR)
HN_RE = "[0-9]+([ -]+[0-9]+)?"

RECORDS = """records_v AS (
  SELECT o_orderkey AS record_id,
    concat('ST ', cast(o_custkey % 40 AS varchar)) AS street_name,
    CASE WHEN o_custkey % 7 = 6 THEN 'ZZ' WHEN o_custkey % 5 = 0 THEN 'NY'
         WHEN o_custkey % 5 = 1 THEN 'BX' WHEN o_custkey % 5 = 2 THEN 'K'
         WHEN o_custkey % 5 = 3 THEN 'QN' ELSE 'R' END AS county,
    CASE WHEN o_orderkey % 10 = 0 THEN NULL
         WHEN o_orderkey % 10 = 1 THEN 'NA'
         WHEN o_orderkey % 10 = 2 THEN concat(cast(o_orderkey % 97 AS varchar), 'A')
         WHEN o_orderkey % 10 = 3 THEN concat(cast(1 + o_orderkey % 4 AS varchar), '-',
                                              right(concat('0', cast(o_custkey % 90 AS varchar)), 2))
         WHEN o_orderkey % 10 = 4 THEN concat(cast(1 + o_orderkey % 4 AS varchar), ' ',
                                              cast(10 + o_custkey % 80 AS varchar))
         ELSE cast(1 + o_custkey % 400 AS varchar) END AS house_no,
    year(o_orderdate) AS issue_year
  FROM orders)"""

SEGMENTS = """segments_v AS (
  SELECT p_partkey AS physical_id,
    concat('ST ', cast(p_partkey % 40 AS varchar)) AS st_name,
    CASE WHEN p_partkey % 3 = 0 THEN concat('ST ', cast(p_partkey % 40 AS varchar))
         ELSE concat('ST ', cast((p_partkey + 5) % 40 AS varchar)) END AS full_street,
    1 + cast(p_partkey % 5 AS integer) AS borough,
    1 + 2 * (p_partkey % 60) AS l_low, 1 + 2 * (p_partkey % 60) + 2 * p_size AS l_high,
    2 + 2 * (p_partkey % 60) AS r_low, 2 + 2 * (p_partkey % 60) + 2 * p_size AS r_high
  FROM part)"""

_pent = ", ".join(f"({a}, {b}, {c}, {d})" for a, b, c, d in PENTAGON)
ZONE_EDGES = f"""zone_edges_v AS (
  SELECT cast(n_nationkey AS bigint) AS zone_id, n_name AS zone_name,
    cast(n_regionkey AS bigint) AS group_id, r_name AS group_name,
    n_nationkey % 5 + 0.5e0 + cast(o.dx AS double) AS x1,
    floor(n_nationkey / 5) + 0.5e0 + cast(o.dy AS double) AS y1,
    n_nationkey % 5 + 0.5e0 + cast(o.ex AS double) AS x2,
    floor(n_nationkey / 5) + 0.5e0 + cast(o.ey AS double) AS y2
  FROM nation JOIN region ON n_regionkey = r_regionkey
  CROSS JOIN (VALUES {_pent}) AS o(dx, dy, ex, ey))"""

TRIPS = """trips_v AS (
  SELECT o_orderkey AS trip_id,
    cast(o_orderkey * 37 % 1000 AS double) / 200 AS px, cast(o_custkey * 53 % 1000 AS double) / 200 AS py,
    cast(o_orderkey * 71 % 1000 AS double) / 200 AS dx, cast(o_custkey * 29 % 1000 AS double) / 200 AS dy
  FROM orders)"""

POSTS = """posts_v AS (
  SELECT doc_id AS post_id, text,
    cast(doc_id * 37 % 1000 AS double) / 200 AS x, cast(doc_id * 53 % 1000 AS double) / 200 AS y
  FROM documents)"""


def county_case(expr: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in COUNTY_CODES.items())
    return f"(CASE {expr} {whens} END)"


def parity_sql(n: str) -> str:
    return f"(CASE WHEN {n} % 2 = 0 THEN 'even' WHEN abs({n} % 2) = 1 THEN 'odd' END)"


def house_sql(text: str, mode: str) -> tuple[str, str, str]:
    """(valid, block, number) SQL expressions for house-number text."""
    t = f"trim(cast({text} AS varchar))"
    parts = f"string_split_regex({t}, '[ -]+')"
    first = f"try_cast({parts}[1] AS integer)"
    last = f"try_cast({parts}[len({parts})] AS integer)"
    if mode == "concat_text":
        block, number = "0", f"try_cast(regexp_replace({t}, '[ -]+', '', 'g') AS integer)"
    elif mode == "concat_int":
        second = (f"(CASE WHEN len({parts}) = 2 THEN cast(try_cast({parts}[2] AS integer) AS varchar)"
                  f" ELSE '' END)")
        block, number = "0", f"try_cast(cast({first} AS varchar) || {second} AS integer)"
    else:
        block, number = f"(CASE WHEN len({parts}) = 2 THEN {first} ELSE 0 END)", last
    ok = f"(regexp_full_match({t}, '{HN_RE}') AND {block} IS NOT NULL AND {number} IS NOT NULL)"
    return ok, block, number


def records_clean(mode: str, years=YEARS) -> str:
    ok, block, number = house_sql("house_no", mode)
    return f"""rec AS (
  SELECT street, borough, block, number, {parity_sql('number')} AS parity, year FROM (
    SELECT upper(street_name) AS street, {county_case('county')} AS borough,
      CASE WHEN {ok} THEN {block} END AS block, CASE WHEN {ok} THEN {number} END AS number,
      cast(issue_year AS integer) AS year
    FROM records_v) t
  WHERE street IS NOT NULL AND borough IS NOT NULL AND number IS NOT NULL
    AND year BETWEEN {min(years)} AND {max(years)})"""


def segment_sides_sql(mode: str, names=("st_name", "full_street"), distinct: bool = True) -> str:
    lo_ok, lo_b, lo_n = house_sql("lo", mode)
    hi_ok, hi_b, hi_n = house_sql("hi", mode)
    unions = " UNION ALL ".join(
        f"SELECT physical_id, '{side}' AS side, {name} AS name, borough, {lo} AS lo, {hi} AS hi "
        f"FROM segments_v"
        for side, lo, hi in (("L", "l_low", "l_high"), ("R", "r_low", "r_high"))
        for name in names)
    return f"""sides AS (
  SELECT {'DISTINCT' if distinct else ''} physical_id, side, street, borough, {parity_sql('low_number')} AS parity,
    low_block, low_number, high_block, high_number FROM (
    SELECT physical_id, side, upper(name) AS street, cast(borough AS integer) AS borough,
      CASE WHEN {lo_ok} THEN {lo_b} END AS low_block, CASE WHEN {lo_ok} THEN {lo_n} END AS low_number,
      CASE WHEN {hi_ok} THEN {hi_b} END AS high_block, CASE WHEN {hi_ok} THEN {hi_n} END AS high_number
    FROM ({unions}) u) t
  WHERE street IS NOT NULL AND low_number IS NOT NULL AND high_number IS NOT NULL)"""


def range_cond(compare: str) -> str:
    if compare == "component":
        return ("r.block BETWEEN s.low_block AND s.high_block "
                "AND r.number BETWEEN s.low_number AND s.high_number")
    return ("(r.block > s.low_block OR (r.block = s.low_block AND r.number >= s.low_number)) "
            "AND (r.block < s.high_block OR (r.block = s.high_block AND r.number <= s.high_number))")


def count_cols_sql(years=YEARS) -> str:
    return ", ".join(f"cast(sum(CASE WHEN r.year = {y} THEN 1 ELSE 0 END) AS bigint) AS count_{y}"
                     for y in years)


def slope_sql(years=YEARS) -> str:
    c = [f"count_{y}" for y in years]
    return f"cast(-2 * {c[0]} - {c[1]} + {c[3]} + 2 * {c[4]} AS double) / 10.0"


DATES = """SELECT o_orderkey AS record_id,
    CASE o_orderkey % 8 WHEN 0 THEN '13/45/2017' WHEN 1 THEN ''
      WHEN 2 THEN cast(year(o_orderdate) AS varchar)
      WHEN 3 THEN strftime(o_orderdate, '%m/%d/%Y')
      WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d')
      ELSE concat(cast(month(o_orderdate) AS varchar), '/', cast(day(o_orderdate) AS varchar), '/',
                  cast(year(o_orderdate) AS varchar)) END AS issue_date
  FROM orders"""
LENIENT_YEAR = ("cast(year(coalesce(try_strptime(issue_date, '%m/%d/%Y'), "
                "try_strptime(issue_date, '%Y-%m-%d'))) AS integer)")
DATED_RECORDS = (f"SELECT v.* EXCLUDE (issue_year), {LENIENT_YEAR} AS issue_year "
                 f"FROM records_v v JOIN ({DATES}) d USING (record_id)")


def trend_sql(mode: str, keep: str, compare: str = "component", null_policy: str = "zero_fill") -> str:
    on = (f"r.street = s.street AND r.borough = s.borough AND r.parity = s.parity "
          f"AND {range_cond(compare)}")
    cnames = ", ".join(f"count_{y}" for y in YEARS)
    ctes = [RECORDS, SEGMENTS, records_clean(mode), segment_sides_sql(mode)]
    if keep == "matched":
        body = f"SELECT s.physical_id, {count_cols_sql()} FROM rec r JOIN sides s ON {on} GROUP BY s.physical_id"
    elif keep == "records":
        body = (f"SELECT s.physical_id, {count_cols_sql()} FROM rec r LEFT JOIN sides s ON {on} "
                f"GROUP BY s.physical_id")
    else:
        body = (f"SELECT g.physical_id, {', '.join(f'm.count_{y}' for y in YEARS)} "
                f"FROM (SELECT DISTINCT physical_id FROM segments_v) g LEFT JOIN "
                f"(SELECT s.physical_id, {count_cols_sql()} FROM rec r JOIN sides s ON {on} "
                f"GROUP BY s.physical_id) m ON g.physical_id = m.physical_id")
    ctes.append(f"counts AS ({body})")
    if null_policy == "zero_fill":
        fill = ", ".join(f"coalesce(count_{y}, 0) AS count_{y}" for y in YEARS)
        ctes.append(f"filled AS (SELECT physical_id, {fill} FROM counts)")
        return f"WITH {', '.join(ctes)} SELECT physical_id, {cnames}, {slope_sql()} AS ols_coeff FROM filled"
    return (f"WITH {', '.join(ctes)} SELECT physical_id, {cnames}, "
            f"coalesce({slope_sql()}, 0.0) AS ols_coeff FROM counts")


def w(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


def _house_q(mode: str) -> str:
    ok, block, number = house_sql("house_no", mode)
    return (w(RECORDS) + f"SELECT record_id, house_no, CASE WHEN {ok} THEN {block} END AS block, "
            f"CASE WHEN {ok} THEN {number} END AS number FROM records_v")


def _yearly(keys: str, years=YEARS) -> str:
    cols = ", ".join(f"cast(count_if(year = {y}) AS bigint) AS count_{y}" for y in years)
    return f"SELECT {keys}, {cols} FROM rec GROUP BY {keys}"


def _pip(points: str, pid: str, px: str, py: str, layer: str, name: str) -> str:
    """(pid, zone_id, zone_name) of points strictly inside a zone (even-odd).

    ``layer`` is a CTE with zone_id, zone_name, x1, y1, x2, y2; the first
    zone by id wins; points on an edge are outside.
    """
    return f"""{name}_cand AS (
  SELECT p.{pid} AS pid, e.zone_id, e.zone_name FROM {points} p JOIN {layer} e
    ON (e.y1 > p.{py}) <> (e.y2 > p.{py})
   AND p.{px} < (e.x2 - e.x1) * (p.{py} - e.y1) / (e.y2 - e.y1) + e.x1
  GROUP BY p.{pid}, e.zone_id, e.zone_name HAVING count(*) % 2 = 1),
{name}_edge AS (
  SELECT DISTINCT p.{pid} AS pid, e.zone_id FROM {points} p JOIN {layer} e
    ON (p.{px} - e.x1) * (e.y2 - e.y1) = (p.{py} - e.y1) * (e.x2 - e.x1)
   AND p.{px} BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
   AND p.{py} BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)),
{name} AS (
  SELECT pid, arg_min(zone_id, zone_id) AS zone_id, arg_min(zone_name, zone_id) AS zone_name
  FROM (SELECT c.* FROM {name}_cand c ANTI JOIN {name}_edge x ON c.pid = x.pid AND c.zone_id = x.zone_id) t
  GROUP BY pid)"""


NBH = "nbh_v AS (SELECT zone_id, zone_name, x1, y1, x2, y2 FROM zone_edges_v)"
BORO = "boro_v AS (SELECT group_id AS zone_id, group_name AS zone_name, x1, y1, x2, y2 FROM zone_edges_v)"
TERMS_SQL = "['the', 'of']"
HITS = f"hits AS (SELECT * FROM posts_v WHERE list_has_any(string_split(text, ' '), {TERMS_SQL}))"
PAIRS = (f"pairs AS (SELECT pu.zone_name AS group_name, dd.zone_name, count(*) AS n "
         f"FROM pu JOIN dd ON pu.pid = dd.pid GROUP BY pu.zone_name, dd.zone_name)")
RANKED = ("ranked AS (SELECT group_name, zone_name, n, row_number() OVER "
          "(PARTITION BY group_name ORDER BY n DESC, zone_name ASC) AS rank FROM pairs)")
TOP3 = [ZONE_EDGES, TRIPS, BORO, NBH, _pip("trips_v", "trip_id", "px", "py", "boro_v", "pu"),
        _pip("trips_v", "trip_id", "dx", "dy", "nbh_v", "dd"), PAIRS, RANKED]


def lcc_sql(lon: str, lat: str) -> tuple[str, str]:
    k = lcc_constants()
    phi = f"radians({lat})"
    es = f"({k['e']!r} * sin({phi}))"
    t = f"(tan({math.pi / 4!r} - {phi} / 2) / pow((1.0 - {es}) / (1.0 + {es}), {k['e'] / 2!r}))"
    rho = f"({k['aF']!r} * pow({t}, {k['n']!r}))"
    theta = f"({k['n']!r} * (radians({lon}) - {k['lon0']!r}))"
    x = f"(({rho} * sin({theta}) + {k['fe']!r}) / {k['unit']!r})"
    y = f"(({k['rho0']!r} - {rho} * cos({theta}) + {k['fn']!r}) / {k['unit']!r})"
    return x, y


_lx, _ly = lcc_sql("-74.25 + px * 0.1", "40.5 + py * 0.1")
_ok_pair = house_sql("house_no", "pair")

ORACLE: dict[str, str] = {
    "segment_trend": trend_sql("pair", "matched"),
    "segment_trend_dup": trend_sql("pair", "matched").replace(
        "FROM segments_v", "FROM (SELECT * FROM segments_v UNION ALL SELECT * FROM segments_v WHERE physical_id % 3 = 0) dup"),
    "segment_trend_dated": trend_sql("pair", "matched").replace("FROM records_v)", f"FROM ({DATED_RECORDS}) dated)"),
    "bad_dates": f"SELECT count(*) AS n, count(*) FILTER ({LENIENT_YEAR} IS NULL) AS n_bad FROM ({DATES}) dates",
    "keyword_long_list": """WITH terms AS (
  SELECT c_name AS term FROM customer UNION SELECT unnest(string_split(text, ' ')) FROM benchmark)
SELECT DISTINCT doc_id FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS token FROM documents) t
WHERE token IN (SELECT term FROM terms)""",
    "range_join_keep_records": trend_sql("concat_int", "records"),
    "range_join_keep_segments": trend_sql("concat_text", "segments", null_policy="zero_slope"),
    "range_join_split": trend_sql("pair", "matched", compare="lexicographic"),
    "proj_prune": w(RECORDS) + "SELECT record_id, street_name AS street, house_no FROM records_v",
    "str_normalize": "SELECT p_partkey AS physical_id, upper(p_name) AS street FROM part",
    "map_code_lookup": w(RECORDS) + f"SELECT record_id, county, {county_case('county')} AS borough "
                                    "FROM records_v",
    "date_year": """WITH d AS (
  SELECT o_orderkey AS record_id,
    CASE o_orderkey % 8 WHEN 0 THEN '13/45/2017' WHEN 1 THEN ''
      WHEN 2 THEN cast(year(o_orderdate) AS varchar)
      WHEN 3 THEN strftime(o_orderdate, '%m/%d/%Y')
      WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d')
      ELSE concat(cast(month(o_orderdate) AS varchar), '/', cast(day(o_orderdate) AS varchar), '/',
                  cast(year(o_orderdate) AS varchar)) END AS issue_date
  FROM orders)
SELECT record_id, issue_date, cast(year(try_strptime(issue_date, '%m/%d/%Y')) AS integer) AS year_strict,
  cast(year(coalesce(try_strptime(issue_date, '%m/%d/%Y'), try_strptime(issue_date, '%Y-%m-%d'))) AS integer)
    AS year_lenient,
  year(try_strptime(issue_date, '%m/%d/%Y')) BETWEEN 1996 AND 2000 AS in_window
FROM d""",
    "date_shapes": """SELECT o_orderkey AS record_id, CASE o_orderkey % 8
    WHEN 0 THEN concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate))
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M')
    WHEN 2 THEN concat(day(o_orderdate), strftime(o_orderdate, ' %b %Y'))
    WHEN 3 THEN concat(strftime(o_orderdate, '%B '), day(o_orderdate), strftime(o_orderdate, ', %Y'))
    WHEN 4 THEN concat(month(o_orderdate), '/', day(o_orderdate), '/', year(o_orderdate), ' ', CASE WHEN hour(CAST(o_orderdate AS TIMESTAMP)) % 12 = 0 THEN 12 ELSE hour(CAST(o_orderdate AS TIMESTAMP)) % 12 END, strftime(o_orderdate, ':%M %p'))
    WHEN 5 THEN strftime(o_orderdate, '%Y%m%d')
    WHEN 6 THEN concat(strftime(o_orderdate, '%a, '), day(o_orderdate), strftime(o_orderdate, ' %B %Y %H:%M:%S'))
    ELSE strftime(o_orderdate, '%m/%d/%y') END AS issue_date,
  CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day
FROM orders""",
    "safe_cast": w(RECORDS) + "SELECT record_id, try_cast(house_no AS integer) AS house_int, "
                              "try_cast(house_no AS double) AS house_double FROM records_v",
    "house_concat_text": _house_q("concat_text"),
    "house_concat_int": _house_q("concat_int"),
    "house_split": _house_q("pair"),
    "parity_label": w(RECORDS) + f"SELECT record_id, number, {parity_sql('number')} AS parity FROM "
                    f"(SELECT record_id, CASE WHEN {_ok_pair[0]} THEN {_ok_pair[2]} END AS number "
                    f"FROM records_v) t",
    "onehot_year": w(RECORDS) + "SELECT record_id, " + ", ".join(
        f"CASE WHEN issue_year = {y} THEN 1 ELSE 0 END AS y{y}" for y in YEARS)
    + f" FROM records_v WHERE issue_year BETWEEN {min(YEARS)} AND {max(YEARS)}",
    "seg_year_counts": w(RECORDS, records_clean("concat_text")) + _yearly("street, borough, parity"),
    "count_all_cols": w(RECORDS, records_clean("concat_text"))
    + "SELECT street, borough, parity, block, number, year, count(*) AS n FROM rec "
      "GROUP BY street, borough, parity, block, number, year",
    "pivot_year": w(RECORDS, records_clean("concat_text"),
                    "c AS (SELECT street, borough, parity, block, number, year, count(*) AS n FROM rec "
                    "GROUP BY ALL)")
    + "SELECT street, borough, parity, block, number, " + ", ".join(
        f"max(CASE WHEN year = {y} THEN n END) AS count_{y}" for y in YEARS)
    + " FROM c GROUP BY street, borough, parity, block, number",
    "slope_wide": w(RECORDS, records_clean("concat_text"), f"c AS ({_yearly('street, borough')})")
    + f"SELECT street, borough, {slope_sql()} AS ols_coeff FROM c",
    "slope_long": w(RECORDS, records_clean("concat_text"), f"c AS ({_yearly('street')})",
                    "l AS (" + " UNION ALL ".join(
                        f"SELECT street, {y} AS year, cast(count_{y} AS double) AS n FROM c"
                        for y in YEARS) + ")")
    + "SELECT street, round(regr_slope(n, year), 6) + cast(0 AS double) AS ols_coeff "
      "FROM l GROUP BY street",
    "dropna_any": w(RECORDS) + "SELECT record_id, house_no FROM records_v WHERE house_no IS NOT NULL "
                               "AND street_name IS NOT NULL AND county IS NOT NULL",
    "fillna_zero": "SELECT physical_id, " + ", ".join(f"coalesce(count_{y}, 0) AS count_{y}" for y in YEARS)
    + " FROM (" + trend_sql("concat_text", "segments", null_policy="zero_slope") + ") t",
    "reject_split": w(RECORDS) + f"SELECT NOT coalesce({_ok_pair[0]} AND {county_case('county')} "
                                 f"IS NOT NULL, false) AS rejected, count(*) AS n FROM records_v GROUP BY 1",
    "reject_reasons": w(RECORDS) + f"SELECT record_id, reason FROM (SELECT record_id, CASE WHEN street_name IS NULL THEN 'street' "
                                   f"WHEN {county_case('county')} IS NULL THEN 'county' WHEN NOT coalesce({_ok_pair[0]}, false) THEN 'house' END "
                                   f"AS reason FROM records_v) t WHERE reason IS NOT NULL",
    "topk_salted": "SELECT o_orderpriority, cast(row_number() OVER (PARTITION BY o_orderpriority ORDER BY cents DESC, o_orderkey) AS integer) AS rank, "
                   "o_orderkey, cents FROM (SELECT o_orderpriority, o_orderkey, cast(round(o_totalprice * 100) AS bigint) AS cents FROM orders) t QUALIFY rank <= 5",
    "segment_sides": w(SEGMENTS, segment_sides_sql("pair", names=("st_name",), distinct=False))
    + "SELECT physical_id, side, street, borough, parity, low_number, high_number FROM sides",
    "segment_alias_explode": w(SEGMENTS, segment_sides_sql("pair", distinct=False))
    + "SELECT physical_id, side, street, parity, low_number, high_number FROM sides",
    "dedup_rows": w(SEGMENTS, segment_sides_sql("pair", distinct=False))
    + "SELECT DISTINCT physical_id, side, street, parity, low_number, high_number FROM sides",
    "pip_assign": w(ZONE_EDGES, TRIPS, NBH, _pip("trips_v", "trip_id", "px", "py", "nbh_v", "pu"))
    + "SELECT t.trip_id, pu.zone_id, pu.zone_name FROM trips_v t LEFT JOIN pu ON t.trip_id = pu.pid",
    "pip_zone_count": w(ZONE_EDGES, TRIPS, BORO, _pip("trips_v", "trip_id", "px", "py", "boro_v", "pu"))
    + "SELECT zone_name, count(*) AS n FROM pu GROUP BY zone_name",
    "zone_count_apart": w(ZONE_EDGES, TRIPS, BORO, _pip("trips_v", "trip_id", "px", "py", "boro_v", "pu"))
    + "SELECT zone_name, count(*) AS n FROM pu GROUP BY zone_name",
    "mixed_layer_count": w(ZONE_EDGES, TRIPS, NBH, BORO, _pip("trips_v", "trip_id", "px", "py", "nbh_v", "pn"),
                           _pip("trips_v", "trip_id", "px", "py", "boro_v", "pb"))
    + "SELECT zone_id, zone_name, count(*) AS n FROM pn GROUP BY zone_id, zone_name "
      "UNION ALL SELECT zone_id + 1000, zone_name, count(*) FROM pb GROUP BY zone_id, zone_name",
    "pip_pair_count": w(*TOP3[:-1]) + "SELECT group_name, zone_name, n FROM pairs",
    "project_lcc": w(TRIPS) + f"SELECT trip_id, round({_lx}, 3) AS x_ft, round({_ly}, 3) AS y_ft "
                              "FROM trips_v",
    "keyword_filter": w(POSTS, HITS) + "SELECT post_id FROM hits",
    "keyword_semi_join": w(POSTS, HITS) + "SELECT post_id, x, y FROM hits",
    "keyword_zone_count": w(POSTS, HITS, ZONE_EDGES, NBH,
                            _pip("hits", "post_id", "x", "y", "nbh_v", "kz"))
    + "SELECT zone_id, count(*) AS n FROM kz GROUP BY zone_id",
    "zone_rate": w(POSTS, HITS, ZONE_EDGES, NBH, _pip("hits", "post_id", "x", "y", "nbh_v", "kz"),
                   "cnt AS (SELECT zone_id, count(*) AS n FROM kz GROUP BY zone_id)",
                   "pop AS (SELECT cast(c_nationkey AS bigint) AS zone_id, count(*) AS population "
                   "FROM customer GROUP BY 1)")
    + "SELECT c.zone_id, c.n, p.population, "
      "cast(c.n AS double) / nullif(cast(p.population AS double), 0) AS rate "
      "FROM cnt c LEFT JOIN pop p ON c.zone_id = p.zone_id",
    "topk_per_group": w(*TOP3) + "SELECT group_name, cast(rank AS integer) AS rank, zone_name, n "
                                 "FROM ranked WHERE rank <= 3",
    "topk_nested": w(*TOP3)
    + "SELECT group_name, string_agg(zone_name, '|' ORDER BY rank) AS names, "
      "string_agg(cast(n AS varchar), '|' ORDER BY rank) AS counts "
      "FROM ranked WHERE rank <= 3 GROUP BY group_name",
    "fmt_topk_line": w(*TOP3)
    + "SELECT group_name, group_name || ',[' || string_agg("
      "'(' || chr(39) || zone_name || chr(39) || ', ' || cast(n AS varchar) || ')', ', ' "
      "ORDER BY rank) || ']' AS line FROM ranked WHERE rank <= 3 GROUP BY group_name",
    "sum_by_key": "SELECT o_orderpriority, cast(sum(cast(round(o_totalprice * 100) AS bigint)) AS bigint) AS total_cents "
                  "FROM orders GROUP BY o_orderpriority",
    "sort_by_key": w(RECORDS) + "SELECT record_id, cast(issue_year AS integer) AS issue_year FROM records_v "
                              "ORDER BY issue_year, record_id",
    "limit_sorted": "SELECT o_orderkey, o_totalprice FROM orders "
                    "ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 10",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
