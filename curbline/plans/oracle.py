"""DuckDB SQL oracles for the registered queries.

The SQL is deliberately a *different* formulation from the Spark plans: it
joins tickets to whole segment rows on borough and street only, and decides
side, range and compound rules with explicit per-branch predicates over the
wide row (the shape of the original scripts), without side unpivot, street-key
explode or house-number blocks. Agreement therefore checks those rewrites.

Tables ``lineitem part orders customer`` are views over the same Parquet files.
"""

from __future__ import annotations

import math

from curbline.policy import MatchPolicy

# Fixed values of the source data and of FIXTURES.md, stated here anew: the oracle shares none with the code it checks.
ALIASES = {1: ["MAN", "MH", "MN", "NEWY", "NEW Y", "NY"], 2: ["BRONX", "BX"], 3: ["BK", "K", "KING", "KINGS"],
           4: ["Q", "QN", "QNS", "QU", "QUEEN"], 5: ["R", "RICHMOND"]}
NOT_IN_SHORT_LIST = {"KING", "KINGS"}
COUNTY_CYCLE = ["MAN", "MH", "MN", "NEWY", "NEW Y", "NY", "BRONX", "BX", "BK", "K", "KING", "KINGS", "Q", "QN", "QNS",
                "QU", "QUEEN", "R", "RICHMOND", "ZZ"]
FIXTURE_YEARS = (1995, 1996, 1997, 1998, 1999)


def aliases_for(name: str) -> dict[int, list[str]]:
    return {code: [a for a in names if name == "full" or a not in NOT_IN_SHORT_LIST] for code, names in ALIASES.items()}

_Q = "'"


def _lit(s: str) -> str:
    return _Q + s.replace(_Q, _Q + _Q) + _Q


def _list(items) -> str:
    return ", ".join(_lit(str(x)) for x in items)


NUMBER = "HUGEINT"  # 38 digits: more than any number of the fixtures has


def strict(x: str) -> str:
    return f"(CASE WHEN regexp_full_match({x}, '[0-9]+') THEN CAST({x} AS {NUMBER}) END)"


# ----------------------------------------------------------------- fixtures

FIXTURE_SQL = f"""
t0 AS (
  SELECT CAST(l.l_orderkey * 10 + l.l_linenumber AS VARCHAR) AS ticket_id,
         strftime(l.l_shipdate, '%m/%d/%Y') AS issue_date,
         [{_list(COUNTY_CYCLE)}][CAST(l.l_orderkey % 20 + 1 AS INTEGER)] AS county,
         CASE l.l_suppkey % 10
           WHEN 0 THEN CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) || '-' || CAST(l.l_partkey % 50 + 1 AS VARCHAR)
           WHEN 1 THEN 'ABC'
           WHEN 2 THEN CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) || 'A'
           WHEN 3 THEN ''
           ELSE CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) END AS house_number,
         upper(p.p_name) AS street_name
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),
s0 AS (
  SELECT CAST(p_partkey AS VARCHAR) AS segment_id,
         CASE WHEN p_partkey % 4 = 0 THEN CAST(p_size % 40 AS VARCHAR) || '-01'
              ELSE CAST(p_size % 40 AS VARCHAR) END AS l_low,
         CASE WHEN p_partkey % 4 = 0 THEN CAST(p_size % 40 + 10 AS VARCHAR) || '-49'
              ELSE CAST(p_size % 40 + 10 AS VARCHAR) END AS l_high,
         CASE WHEN p_partkey % 13 = 0 THEN ''
              WHEN p_partkey % 4 = 0 THEN CAST(p_size % 40 AS VARCHAR) || '-02'
              ELSE CAST(p_size % 40 AS VARCHAR) END AS r_low,
         CASE WHEN p_partkey % 13 = 0 THEN ''
              WHEN p_partkey % 4 = 0 THEN CAST(p_size % 40 + 10 AS VARCHAR) || '-50'
              ELSE CAST(p_size % 40 + 10 AS VARCHAR) END AS r_high,
         CASE WHEN p_partkey % 11 = 0 OR p_partkey % 7 = 0 THEN p_name
              WHEN p_partkey % 3 = 0 THEN 'alt ' || p_name ELSE p_name END AS street_label,
         CAST(p_partkey % 5 + 1 AS VARCHAR) AS boro_code,
         CASE WHEN p_partkey % 11 = 0 THEN ''
              WHEN p_partkey % 7 = 0 THEN 'alt ' || p_name ELSE p_name END AS full_street,
         p_name AS alt_label
  FROM part
),
ev AS (
  SELECT CAST(o_custkey AS VARCHAR) AS id, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(o_orderkey AS VARCHAR) AS event_id
  FROM orders
  WHERE year(o_orderdate) BETWEEN {FIXTURE_YEARS[0]} AND {FIXTURE_YEARS[-1]}
),
sp AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer
       UNION ALL SELECT 'S' || CAST(s_suppkey AS VARCHAR) FROM supplier)"""


def _longer_sql(col: str, kind: str) -> str:
    return (f"(CASE WHEN NOT regexp_full_match({col}, '[0-9]+') OR {kind} = 0 THEN {col} "
            f"WHEN {kind} = 1 THEN lpad({col}, 30, '0') WHEN {kind} = 2 THEN {col} || repeat('0', 20) "
            f"ELSE '1' || lpad({col}, 19, '0') END)")


_K = "CAST(segment_id AS BIGINT)"
LONG_FIXTURE_SQL = (
    FIXTURE_SQL.replace("t0 AS (", "short_t AS (", 1).replace("s0 AS (", "short_s AS (", 1) + f""",
t0 AS (SELECT * REPLACE ({_longer_sql('house_number', 'CAST(ticket_id AS BIGINT) % 4')} AS house_number) FROM short_t),
s0 AS (SELECT * REPLACE (
         {_longer_sql('l_low', _K + ' % 4')} AS l_low,
         CASE WHEN {_K} % 8 = 5 THEN l_high || repeat('0', 20) ELSE {_longer_sql('l_high', _K + ' % 4')} END AS l_high,
         {_longer_sql('r_low', _K + ' % 4')} AS r_low, {_longer_sql('r_high', _K + ' % 4')} AS r_high,
         CASE WHEN {_K} % 17 = 0 THEN '99999999999' WHEN {_K} % 19 = 0 THEN 'X'
              WHEN {_K} % 23 = 0 THEN repeat('9', 25) ELSE boro_code END AS boro_code) FROM short_s)""")


def _moved_sql(col: str, shift: str) -> str:
    return (f"(CASE WHEN regexp_full_match({col}, '[0-9]+') "
            f"THEN CAST(CAST({col} AS BIGINT) + {shift} AS VARCHAR) ELSE {col} END)")


_MORE = f"CASE WHEN {_K} % 29 = 0 THEN 20000 WHEN {_K} % 5 = 0 THEN 150 ELSE 0 END"
SPREAD_FIXTURE_SQL = (
    FIXTURE_SQL.replace("t0 AS (", "short_t AS (", 1).replace("s0 AS (", "short_s AS (", 1) + f""",
t0 AS (SELECT * REPLACE ({_moved_sql('house_number', 'CAST(ticket_id AS BIGINT) % 20 * 50')} AS house_number)
       FROM short_t),
s0 AS (SELECT * REPLACE (
         {_moved_sql('l_low', _K + ' % 20 * 50')} AS l_low, {_moved_sql('r_low', _K + ' % 20 * 50')} AS r_low,
         {_moved_sql('l_high', f'{_K} % 20 * 50 + {_MORE}')} AS l_high,
         {_moved_sql('r_high', f'{_K} % 20 * 50 + {_MORE}')} AS r_high,
         CASE WHEN {_K} % 2 = 0 THEN upper(full_street) ELSE full_street END AS full_street,
         CASE WHEN {_K} % 3 = 0 THEN 'old ' || alt_label ELSE alt_label END AS alt_label,
         CASE WHEN {_K} % 31 = 0 THEN '' ELSE segment_id END AS segment_id) FROM short_s)""")


def with_fixtures(*ctes: str, fixtures: str = FIXTURE_SQL) -> str:
    """``WITH`` clause holding the fixtures followed by extra CTEs."""
    return "WITH " + ",\n".join([fixtures.strip()] + [c.strip() for c in ctes])


# ---------------------------------------------------------- normalisation


def boro_sql(col: str, aliases: str) -> str:
    whens = " ".join(f"WHEN {col} IN ({_list(names)}) THEN {code}"
                     for code, names in aliases_for(aliases).items())
    return f"(CASE {whens} END)"


def fold_sql(col: str, fold_case: bool) -> str:
    return f"lower({col})" if fold_case else col


def house_sql(col: str, ticket_split: str) -> tuple[str, str]:
    if ticket_split == "first_two":
        base = f"(CASE WHEN contains({col}, '-') THEN split_part({col}, '-', 1) ELSE {col} END)"
        suffix = f"(CASE WHEN contains({col}, '-') THEN split_part({col}, '-', 2) END)"
        return strict(base), strict(suffix)
    ok = f"regexp_full_match({col}, '[0-9]+(-[0-9]+)*')"
    base = f"(CASE WHEN {ok} THEN CAST(split_part({col}, '-', 1) AS {NUMBER}) END)"
    suffix = (f"(CASE WHEN {ok} THEN CAST(coalesce(nullif(split_part({col}, '-', 2), ''), '0') AS {NUMBER}) END)")
    return base, suffix


def valid_ticket_sql(policy: MatchPolicy, alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return (f"right({a}issue_date, 4) IN ({_list(policy.years)}) "
            f"AND {boro_sql(a + 'county', policy.aliases)} IS NOT NULL "
            f"AND {a}street_name <> '' AND {a}house_number <> ''")


def tickets_cte(policy: MatchPolicy, name: str = "t", drop_unparsed: bool = True) -> str:
    hn, suffix = house_sql("house_number", policy.ticket_split)
    where = valid_ticket_sql(policy)
    inner = f"""
  SELECT ticket_id, CAST(right(issue_date, 4) AS INTEGER) AS year,
         {boro_sql('county', policy.aliases)} AS boro,
         {fold_sql('street_name', policy.fold_case)} AS street,
         {hn} AS hn, {suffix} AS hn_suffix
  FROM t0 WHERE {where}"""
    if drop_unparsed:
        return f"{name} AS (SELECT * FROM ({inner}) WHERE hn IS NOT NULL)"
    return f"{name} AS ({inner})"


def end_sql(col: str, mode: str, other: str) -> tuple[str, str]:
    """(base, suffix) of one range end; ``other`` is the side's other end."""
    if mode == "each":
        base = f"(CASE WHEN contains({col}, '-') THEN split_part({col}, '-', 1) ELSE {col} END)"
        suffix = f"(CASE WHEN contains({col}, '-') THEN split_part({col}, '-', 2) END)"
        return strict(base), strict(suffix)
    if mode == "pairwise":
        both = f"(contains({col}, '-') AND contains({other}, '-'))"
        base = f"(CASE WHEN {both} THEN split_part({col}, '-', 1) ELSE {col} END)"
        part2 = f"split_part({col}, '-', 2)"
        suffix = f"(CASE WHEN {both} THEN {strict(part2)} END)"
        return strict(base), suffix
    if mode == "strict_zero":
        ok = (f"(regexp_full_match({col}, '[0-9]+(-[0-9]+)*') "
              f"AND regexp_full_match({other}, '[0-9]+(-[0-9]+)*'))")
        base = f"(CASE WHEN {ok} THEN CAST(split_part({col}, '-', 1) AS {NUMBER}) END)"
        suffix = f"(CASE WHEN {ok} THEN CAST(coalesce(nullif(split_part({col}, '-', 2), ''), '0') AS {NUMBER}) END)"
        return base, suffix
    raise ValueError(mode)


def segments_cte(policy: MatchPolicy, name: str = "s") -> str:
    m = policy.segment_split
    ll, llc = end_sql("l_low", m, "l_high")
    lh, lhc = end_sql("l_high", m, "l_low")
    rl, rlc = end_sql("r_low", m, "r_high")
    rh, rhc = end_sql("r_high", m, "r_low")
    full = fold_sql("full_street", policy.fold_case)
    label = fold_sql(policy.label_column, policy.fold_case)
    return f"""{name} AS (
  SELECT segment_id, {strict('boro_code')} AS boro, {full} AS full_name, {label} AS label_name,
         {ll} AS ll, {lh} AS lh, {llc} AS llc, {lhc} AS lhc,
         {rl} AS rl, {rh} AS rh, {rlc} AS rlc, {rhc} AS rhc
  FROM s0 WHERE segment_id IS NOT NULL AND segment_id <> '')"""


def street_match_sql(policy: MatchPolicy) -> str:
    if policy.street_key == "full":
        return "t.street = s.full_name"
    if policy.street_key == "coalesce":
        return "t.street = coalesce(nullif(s.full_name, ''), s.label_name)"
    return "(t.street = s.full_name OR t.street = s.label_name)"


def multiplicity_sql(policy: MatchPolicy) -> str:
    """Number of times one (ticket, segment) pair counts, as a branch sum."""
    odd, even = "t.hn % 2 = 1", "t.hn % 2 = 0"
    in_l, in_r = "t.hn BETWEEN s.ll AND s.lh", "t.hn BETWEEN s.rl AND s.rh"
    sfx_l, sfx_r = "t.hn_suffix BETWEEN s.llc AND s.lhc", "t.hn_suffix BETWEEN s.rlc AND s.rhc"
    rule = policy.compound
    if rule == "four_branch":
        plain = f"(CASE WHEN {odd} AND {in_l} THEN 1 WHEN {even} AND {in_r} THEN 1 ELSE 0 END)"
        comp = (f"(CASE WHEN t.hn_suffix % 2 = 1 AND {in_l} AND {sfx_l} THEN 1 "
                f"WHEN t.hn_suffix % 2 = 0 AND {in_r} AND {sfx_r} THEN 1 ELSE 0 END)")
        return f"({plain} + {comp})"
    if rule == "same_side":
        cond = (f"(t.hn_suffix IS NULL AND (({odd} AND {in_l}) OR ({even} AND {in_r}))) OR "
                f"(t.hn_suffix IS NOT NULL AND (({odd} AND {in_l} AND {sfx_l}) OR ({even} AND {in_r} AND {sfx_r})))")
    elif rule == "either_side":
        side = f"(({odd} AND {in_l}) OR ({even} AND {in_r}))"
        cond = (f"(t.hn_suffix IS NULL AND {side}) OR "
                f"(t.hn_suffix IS NOT NULL AND {side} AND ({sfx_l} OR {sfx_r}))")
    elif rule == "wrong_high":
        cond = (f"({odd} AND {in_l} AND (t.hn_suffix IS NULL OR (s.llc IS NOT NULL AND s.lhc IS NOT NULL "
                f"AND t.hn_suffix >= s.llc AND t.hn <= s.lhc))) OR "
                f"({even} AND {in_r} AND (t.hn_suffix IS NULL OR (s.rlc IS NOT NULL AND s.rhc IS NOT NULL "
                f"AND t.hn_suffix >= s.rlc AND t.hn <= s.rhc)))")
    elif rule == "zero_default":
        cond = f"({odd} AND {in_l} AND {sfx_l}) OR ({even} AND {in_r} AND {sfx_r})"
    else:
        raise ValueError(rule)
    return f"(CASE WHEN {cond} THEN 1 ELSE 0 END)"


def matches_cte(policy: MatchPolicy, name: str = "m") -> str:
    return f"""{name} AS (
  SELECT s.segment_id, t.ticket_id, t.year, t.hn, {multiplicity_sql(policy)} AS n
  FROM t JOIN s ON t.boro = s.boro AND {street_match_sql(policy)})"""


def counts_cte(policy: MatchPolicy, name: str = "c") -> str:
    if policy.dedup == "none":
        body = "SELECT segment_id, year, CAST(sum(n) AS BIGINT) AS n FROM m WHERE n > 0 GROUP BY segment_id, year"
    elif policy.dedup == "id_ticket_year_side":
        # odd and even numbers are matched, deduplicated and counted apart, then united
        sides = [("SELECT DISTINCT segment_id, ticket_id, year FROM m "
                  f"WHERE n > 0 AND hn % 2 = {odd}") for odd in (1, 0)]
        body = (f"SELECT segment_id, year, count(*) AS n FROM ({' UNION ALL '.join(sides)}) "
                "GROUP BY segment_id, year")
    elif policy.dedup == "id_ticket_year":
        body = ("SELECT segment_id, year, count(*) AS n FROM "
                "(SELECT DISTINCT segment_id, ticket_id, year FROM m WHERE n > 0) GROUP BY segment_id, year")
    else:
        body = ("SELECT segment_id, year, count(*) AS n FROM "
                "(SELECT segment_id, ticket_id, min(year) AS year FROM m WHERE n > 0 "
                "GROUP BY segment_id, ticket_id) GROUP BY segment_id, year")
    return f"{name} AS ({body})"


def spine_cte(policy: MatchPolicy, name: str = "ids") -> str:
    if policy.spine == "all_ids":
        spine = "SELECT segment_id FROM s0 WHERE segment_id IS NOT NULL AND segment_id <> ''"
    else:
        ll, _ = end_sql("l_low", policy.segment_split, "l_high")
        lh, _ = end_sql("l_high", policy.segment_split, "l_low")
        spine = (f"SELECT segment_id FROM s0 WHERE segment_id IS NOT NULL AND segment_id <> '' "
                 f"AND {ll} IS NOT NULL AND {lh} IS NOT NULL")
    return f"{name} AS ({spine} UNION SELECT segment_id FROM c)"


def slope_sql(cols: list[str], xs: list[int] | None = None) -> str:
    """sum((x - mean) * y) / sum((x - mean)^2) as integer weights over the columns."""
    n = len(cols)
    xs = list(range(n)) if xs is None else list(xs)
    mean_num = sum(xs)  # mean = mean_num / n
    dev = [n * x - mean_num for x in xs]  # n * (x - mean), integers
    g = 0
    for v in dev:
        g = math.gcd(g, v)
    w = [v // g for v in dev]
    d = g * sum(v * v for v in w) / n
    terms = " + ".join(f"({v}) * {c}" for v, c in zip(w, cols) if v)
    return f"(CAST({terms} AS DOUBLE) / {float(d)!r})"


def round_sql(expr: str, mode: str) -> str:
    if mode == "none":
        return expr
    if mode == "int_half_even":
        return f"CAST(round_even({expr}, 0) AS BIGINT)"
    # "+ 0.0" turns a negative zero into 0.0 (decimal rounding has none)
    return f"(round_even({expr}, 2) + 0.0)"


def wide_cte(years, ids: str = "ids", counts: str = "c", id_col: str = "segment_id", name: str = "w") -> str:
    cols = ", ".join(
        f"CAST(coalesce(sum(CASE WHEN {counts}.year = {y} THEN {counts}.n END), 0) AS BIGINT) AS count_{y}"
        for y in years)
    return (f"{name} AS (SELECT {ids}.{id_col}, {cols} FROM {ids} "
            f"LEFT JOIN {counts} ON {ids}.{id_col} = {counts}.{id_col} GROUP BY {ids}.{id_col})")


def per_year_rows_cte(years, name: str = "w2", src: str = "w", id_col: str = "segment_id") -> str:
    cols = [f"count_{y}" for y in years]
    parts = []
    for c in cols:
        sel = ", ".join((c if o == c else "CAST(0 AS BIGINT)") + f" AS {o}" for o in cols)
        parts.append(f"SELECT {id_col}, {sel} FROM {src} WHERE {c} > 0")
    zeros = ", ".join(f"CAST(0 AS BIGINT) AS {o}" for o in cols)
    none = " AND ".join(f"{c} = 0" for c in cols)
    parts.append(f"SELECT {id_col}, {zeros} FROM {src} WHERE {none}")
    return f"{name} AS (" + " UNION ALL ".join(parts) + ")"


def report_sql(policy: MatchPolicy, fixtures: str = FIXTURE_SQL) -> str:
    cols = policy.count_columns
    ctes = [tickets_cte(policy), segments_cte(policy), matches_cte(policy), counts_cte(policy),
            spine_cte(policy), wide_cte(policy.years)]
    src = "w"
    if policy.group == "per_id_year":
        ctes.append(per_year_rows_cte(policy.years))
        src = "w2"
    slope = round_sql(slope_sql(cols, list(policy.years)), policy.rounding)
    order = " ORDER BY segment_id" if policy.order_by_id else ""
    return (with_fixtures(*ctes, fixtures=fixtures)
            + f"\nSELECT segment_id, {', '.join(cols)}, {slope} AS slope FROM {src}{order}")
