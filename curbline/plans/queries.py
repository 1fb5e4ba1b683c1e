"""Registered queries: one per operator family of the inventory.

Each query reads the whole test tables (through the derived ticket/segment
fixtures or the orders/customer event fixtures) and has a DuckDB oracle in
``ORACLES``. Count columns are BIGINT, years INT, ids VARCHAR, slopes DOUBLE in
both engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.functions.parsing import (
    fold,
    house_suffix_parses,
    side_texts,
    street_key_coalesce,
    strict_int,
    year_suffix,
)
from curbline.functions.trend import apply_rounding, centred_slope_expr, row_mean_expr, slope_expr
from curbline.operators import counting
from curbline.operators.regression import event_sums, grid_slope, merged
from curbline.operators.segments import borough_number, parsed_sides, street_keys
from curbline.operators.tickets import house_number_parts, normalize_tickets, observed_rejects, reject_reason
from curbline.plans import oracle as O
from curbline.plans.report import segment_counts, segment_report
from curbline.policy import PRESETS, MatchPolicy, preset
from curbline.session import checkpoint_path
from curbline.sources.csv_io import (
    TICKET_COLUMNS,
    TICKET_FIELDS,
    TICKET_SCHEMA,
    TICKET_WIDTH,
    read_segments_csv,
    read_tickets_csv,
    read_tickets_parquet,
    sorted_rows,
    write_report_csv,
    write_report_sorted,
    write_segments_csv,
    write_tickets_csv,
)
from curbline.sources.fixtures import (
    FIXTURE_YEARS,
    fixture_events,
    fixture_long_segments,
    fixture_long_tickets,
    fixture_segments,
    fixture_spine,
    fixture_spread_segments,
    fixture_spread_tickets,
    fixture_tickets,
    table,
)
from curbline.sources.ledger import ledger_report, refresh

Query = Callable[[SparkSession, str], DataFrame]
YEARS = FIXTURE_YEARS
COUNT_COLS = [f"count_{y}" for y in YEARS]


def fixture_policy(name: str = "canonical", **overrides) -> MatchPolicy:
    return preset(name, **{"years": YEARS, **overrides})


CANON = fixture_policy()

# --------------------------------------------------------------- tickets


def q_valid_tickets_by_code(spark, sf):
    t = normalize_tickets(fixture_tickets(spark, sf), CANON, drop_unparsed=False)
    return t.groupBy("boro", "year").agg(F.count(F.lit(1)).alias("n_tickets"))


SQL_VALID_TICKETS = O.with_fixtures(O.tickets_cte(CANON, drop_unparsed=False)) + """
SELECT boro, year, count(*) AS n_tickets FROM t GROUP BY boro, year"""


def q_house_number_split(spark, sf):
    h = F.col("house_number")
    hn, sfx = house_number_parts(h, "first_two")
    thn, tsfx = house_number_parts(h, "strict_tuple")
    return (fixture_tickets(spark, sf).select("house_number").where(h.isNotNull()).distinct()
            .select("house_number", hn.alias("hn"), sfx.alias("hn_suffix"),
                    thn.alias("tuple_hn"), tsfx.alias("tuple_suffix"),
                    ((hn % 2) == 1).alias("hn_odd"),
                    h.rlike(r"^\p{L}+\z").alias("is_alpha")))


_hn, _sfx = O.house_sql("house_number", "first_two")
_thn, _tsfx = O.house_sql("house_number", "strict_tuple")
SQL_HOUSE_NUMBER_SPLIT = O.with_fixtures(
    "h AS (SELECT DISTINCT house_number FROM t0 WHERE house_number IS NOT NULL)") + f"""
SELECT house_number, CAST({_hn} AS BIGINT) AS hn, CAST({_sfx} AS BIGINT) AS hn_suffix,
       CAST({_thn} AS BIGINT) AS tuple_hn, CAST({_tsfx} AS BIGINT) AS tuple_suffix,
       ({_hn} % 2 = 1) AS hn_odd, regexp_full_match(house_number, '\\p{{L}}+') AS is_alpha
FROM h"""


def q_reject_reasons(spark, sf):
    t = fixture_tickets(spark, sf)
    return t.groupBy(reject_reason(CANON).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


SQL_REJECT_REASONS = O.with_fixtures() + f"""
SELECT CASE WHEN NOT coalesce(right(issue_date, 4) IN ({O._list(YEARS)}), false) THEN 'out_of_window'
            WHEN {O.boro_sql('county', 'full')} IS NULL THEN 'unknown_county'
            WHEN coalesce(street_name, '') = '' THEN 'empty_street'
            WHEN coalesce(house_number, '') = '' THEN 'empty_house'
            WHEN regexp_full_match(house_number, '\\p{{L}}+') THEN 'alpha_house'
            WHEN {_hn} IS NULL THEN 'unparsed_house'
            ELSE 'ok' END AS reason,
       count(*) AS n
FROM t0 GROUP BY 1"""

# -------------------------------------------------------------- segments


def q_segment_pair_split(spark, sf):
    s = fixture_segments(spark, sf)
    modes = ("each", "pairwise", "strict_zero")

    names = ("lo", "hi", "lo_c", "hi_c")

    def side(is_left, lo, hi):
        texts = {f"{m}_{n}": t for m in modes for n, t in zip(names, side_texts(F.col(lo), F.col(hi), m))}
        return F.struct(F.lit(is_left).alias("is_left"), *[t.alias(n) for n, t in texts.items()])

    rows = s.select("segment_id", F.inline(F.array(side(True, "l_low", "l_high"), side(False, "r_low", "r_high"))))
    # a generator for each mode, so that one method parses four numbers and not all twelve
    for m in modes:
        parsed = F.struct(*[strict_int(F.col(f"{m}_{n}")).alias(f"{m}_{n}") for n in names])
        rows = rows.select(*[c for c in rows.columns if c not in [f"{m}_{n}" for n in names]], F.inline(F.array(parsed)))
    return rows


def _side_split_sql(is_left: bool, lo: str, hi: str) -> str:
    cols = []
    for m in ("each", "pairwise", "strict_zero"):
        a, c = O.end_sql(lo, m, hi)
        b, d = O.end_sql(hi, m, lo)
        cols += [f"CAST({x} AS BIGINT) AS {m}_{name}" for x, name in zip((a, b, c, d), ("lo", "hi", "lo_c", "hi_c"))]
    return f"SELECT segment_id, {str(is_left).lower()} AS is_left, " + ", ".join(cols) + " FROM s0"


SQL_SEGMENT_PAIR_SPLIT = (O.with_fixtures() + "\n" + _side_split_sql(True, "l_low", "l_high")
                          + "\nUNION ALL\n" + _side_split_sql(False, "r_low", "r_high"))


def q_street_key_coalesce(spark, sf):
    s = fixture_segments(spark, sf)
    return s.select("segment_id", street_key_coalesce(F.col("full_street"), F.col("street_label")).alias("street_key"))


SQL_STREET_KEY_COALESCE = O.with_fixtures() + """
SELECT segment_id, coalesce(nullif(full_street, ''), street_label) AS street_key FROM s0"""

SIDE_POLICY = fixture_policy("side_unpivot")


def q_segment_side_unpivot(spark, sf):
    sides = parsed_sides(fixture_segments(spark, sf), SIDE_POLICY)
    return (sides.where(F.col("lo").isNotNull() & F.col("hi").isNotNull())
            .select("segment_id", "is_left", "lo", "hi", "lo_c", "hi_c"))


def _unpivot_sql() -> str:
    parts = []
    for is_left, lo, hi in ((True, "l_low", "l_high"), (False, "r_low", "r_high")):
        a, c = O.end_sql(lo, "strict_zero", hi)
        b, d = O.end_sql(hi, "strict_zero", lo)
        parts.append(f"SELECT segment_id, {str(is_left).lower()} AS is_left, "
                     f"CAST({a} AS BIGINT) AS lo, CAST({b} AS BIGINT) AS hi, "
                     f"CAST({c} AS BIGINT) AS lo_c, CAST({d} AS BIGINT) AS hi_c FROM s0 WHERE segment_id <> '' AND {a} IS NOT NULL AND {b} IS NOT NULL")
    return O.with_fixtures() + "\n" + "\nUNION ALL\n".join(parts)


SQL_SEGMENT_SIDE_UNPIVOT = _unpivot_sql()

# ----------------------------------------------------------------- joins

EQUI_POLICY = CANON  # folded case, so that the fixture's names meet


def _ticket_streets(spark, sf) -> DataFrame:
    """Valid tickets pre-aggregated to one row per (boro, street)."""
    t = normalize_tickets(fixture_tickets(spark, sf), EQUI_POLICY, drop_unparsed=False)
    return t.groupBy("boro", "street").agg(F.count(F.lit(1)).alias("n"))


def _segment_keys(spark, sf) -> DataFrame:
    s = fixture_segments(spark, sf)
    full = fold(F.col("full_street"), True)
    coal = fold(street_key_coalesce(F.col("full_street"), F.col("street_label")), True)
    either = street_keys(EQUI_POLICY.with_(street_key="either"))
    kinds = F.array(
        F.struct(F.lit("full").alias("kind"), F.array(full).alias("keys")),
        F.struct(F.lit("coalesce").alias("kind"), F.array(coal).alias("keys")),
        F.struct(F.lit("either").alias("kind"), either.alias("keys")),
    )
    return (s.select("segment_id", borough_number(F.col("boro_code")).alias("boro"), F.inline(kinds))
            .select("segment_id", "boro", "kind", F.explode("keys").alias("street")))


def _equi_counts(spark, sf, kinds: list[str]) -> DataFrame:
    keys = _segment_keys(spark, sf).where(F.col("kind").isin(kinds))
    # keys that can't meet a valid ticket don't travel; their segments keep their zero row
    joined = (keys.where("boro is not null and street <> ''").join(_ticket_streets(spark, sf), ["boro", "street"])
              .select("segment_id", "kind", "n"))
    ids = fixture_segments(spark, sf).select("segment_id", F.lit("").alias("kind"), F.lit(0).cast("bigint").alias("n"))
    zero = F.lit(0).cast("bigint")
    return joined.unionByName(ids).groupBy("segment_id").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), zero).alias(f"pairs_{k}") for k in kinds]
    )


def q_equi_join_counts(spark, sf):
    return _equi_counts(spark, sf, ["full", "coalesce"])


def q_either_name_join_counts(spark, sf):
    return _equi_counts(spark, sf, ["either"])


_EQ = O.with_fixtures(O.tickets_cte(EQUI_POLICY, drop_unparsed=False), O.segments_cte(EQUI_POLICY),
                      "tk AS (SELECT boro, street, count(*) AS n FROM t GROUP BY boro, street)")
SQL_EQUI_JOIN_COUNTS = _EQ + """
SELECT s.segment_id,
  CAST(coalesce((SELECT sum(n) FROM tk WHERE tk.boro = s.boro AND tk.street = s.full_name), 0) AS BIGINT) AS pairs_full,
  CAST(coalesce((SELECT sum(n) FROM tk WHERE tk.boro = s.boro
                 AND tk.street = coalesce(nullif(s.full_name, ''), s.label_name)), 0) AS BIGINT) AS pairs_coalesce
FROM s"""
SQL_EITHER_NAME_JOIN_COUNTS = _EQ + """
SELECT s.segment_id,
  CAST(coalesce((SELECT sum(n) FROM tk WHERE tk.boro = s.boro
                 AND (tk.street = s.full_name OR tk.street = s.label_name)), 0) AS BIGINT) AS pairs_either
FROM s"""


def _match_counts(spark, sf, policy: MatchPolicy, ticket_filter=None) -> DataFrame:
    """Matches per (segment, year); ``ticket_filter`` applies to the raw ticket text."""
    raw = fixture_tickets(spark, sf)
    if ticket_filter is not None:
        raw = raw.where(ticket_filter)
    counts = segment_counts(raw, fixture_segments(spark, sf), policy)
    return counts.groupBy("segment_id", "year").agg(F.sum("n").cast("bigint").alias("n"))


def _match_counts_sql(policy: MatchPolicy, ticket_where: str | None = None) -> str:
    tick = O.tickets_cte(policy, name="t_all")
    where = f" WHERE {ticket_where}" if ticket_where else ""
    return O.with_fixtures(tick, f"t AS (SELECT * FROM t_all{where})", O.segments_cte(policy),
                           O.matches_cte(policy), O.counts_cte(policy)) + """
SELECT segment_id, year, n FROM c"""


def q_range_match_plain(spark, sf):
    """Tickets whose number has no integer suffix (hn_suffix IS NULL)."""
    return _match_counts(spark, sf, CANON, ~F.coalesce(house_suffix_parses(F.col("house_number")), F.lit(False)))


def q_range_match_compound(spark, sf):
    """Tickets whose number has an integer suffix (hn_suffix IS NOT NULL)."""
    return _match_counts(spark, sf, CANON, house_suffix_parses(F.col("house_number")))


BRANCH_POLICY = fixture_policy("four_branch", fold_case=True)


def q_branch_union_all(spark, sf):
    return _match_counts(spark, sf, BRANCH_POLICY)


DEDUP_YEAR_POLICY = CANON.with_(dedup="id_ticket_year")
DEDUP_TICKET_POLICY = CANON.with_(dedup="id_ticket")


def q_distinct_id_ticket_year(spark, sf):
    return _match_counts(spark, sf, DEDUP_YEAR_POLICY)


def q_distinct_id_ticket(spark, sf):
    return _match_counts(spark, sf, DEDUP_TICKET_POLICY)


# --------------------------------------------------------------- reports


def _report_query(policy: MatchPolicy) -> Query:
    def run(spark, sf):
        return segment_report(fixture_tickets(spark, sf), fixture_segments(spark, sf), policy)
    return run


# ---------------------------------------------------- counts and trends


def _events(spark, sf):
    return fixture_events(spark, sf)


def q_count_per_id_year(spark, sf):
    return counting.count_per_id_year(_events(spark, sf))


def q_yearly_pivot(spark, sf):
    return counting.yearly_pivot(_events(spark, sf), YEARS)


def q_yearly_pivot_per_id_year(spark, sf):
    return counting.yearly_pivot_per_id_year(_events(spark, sf), YEARS)


ABSENT_YEAR = 2005  # after all orders


def q_yearly_pivot_absent_year(spark, sf):
    """A year of the window without any event still has its column."""
    return counting.yearly_pivot(_events(spark, sf), [*YEARS, ABSENT_YEAR])


def q_one_hot_vector_sum(spark, sf):
    return counting.one_hot_vector_sum(_events(spark, sf), YEARS)


def q_spine_zero_fill(spark, sf):
    return counting.spine_zero_fill(fixture_spine(spark, sf), counting.yearly_pivot(_events(spark, sf), YEARS))


def q_spine_union_zero(spark, sf):
    return counting.spine_union_zero(fixture_spine(spark, sf), _events(spark, sf), YEARS)


def _trend_base(spark, sf):
    return counting.spine_union_zero(fixture_spine(spark, sf), _events(spark, sf), YEARS)


def q_trend_slope(spark, sf):
    w = _trend_base(spark, sf)
    return w.select("id", *COUNT_COLS, row_mean_expr(COUNT_COLS).alias("row_mean"),
                    slope_expr(COUNT_COLS).alias("slope"))


def q_trend_slope_int(spark, sf):
    w = _trend_base(spark, sf)
    return w.select("id", apply_rounding(slope_expr(COUNT_COLS), "int_half_even").alias("slope_int"))


def q_trend_slope_long(spark, sf):
    """Long form: the zero-filled (id x year) grid and ``regr_slope``."""
    w = _trend_base(spark, sf)
    grid = w.select("id", F.inline(F.array(*[
        F.struct(F.lit(y).alias("year"), F.col(f"count_{y}").alias("n")) for y in YEARS])))
    slope = F.regr_slope(F.col("n").cast("double"), F.col("year").cast("double"))
    return grid.groupBy("id").agg(F.round(slope, 9).alias("slope"))


def q_trend_slope_centred(spark, sf):
    """The mean-centred form, rounded to 9 places like the long form."""
    w = _trend_base(spark, sf)
    return w.select("id", F.round(centred_slope_expr(COUNT_COLS), 9).alias("slope"))


_EV_PIVOT = ", ".join(f"count(*) FILTER (WHERE year = {y}) AS count_{y}" for y in YEARS)
_EV_WIDE = O.with_fixtures(
    "ids AS (SELECT DISTINCT id FROM sp)",
    "c AS (SELECT id, year, count(*) AS n FROM ev GROUP BY id, year)",
    O.wide_cte(YEARS, ids="ids", counts="c", id_col="id"),
)
_CC = ", ".join(COUNT_COLS)
SQL_COUNT_PER_ID_YEAR = O.with_fixtures() + "\nSELECT id, year, count(*) AS n FROM ev GROUP BY id, year"
SQL_YEARLY_PIVOT = O.with_fixtures() + f"\nSELECT id, {_EV_PIVOT} FROM ev GROUP BY id"
SQL_YEARLY_PIVOT_PER_ID_YEAR = O.with_fixtures() + "\nSELECT id, " + ", ".join(
    f"CASE WHEN year = {y} THEN count(*) ELSE 0 END AS count_{y}" for y in YEARS) + " FROM ev GROUP BY id, year"
SQL_SPINE_ZERO_FILL = _EV_WIDE + f"\nSELECT id, {_CC} FROM w"
SQL_TREND_SLOPE = _EV_WIDE + (f"\nSELECT id, {_CC}, CAST({' + '.join(COUNT_COLS)} AS DOUBLE) / {float(len(YEARS))} "
                              f"AS row_mean, {O.slope_sql(COUNT_COLS)} AS slope FROM w")
SQL_TREND_SLOPE_INT = _EV_WIDE + f"\nSELECT id, {O.round_sql(O.slope_sql(COUNT_COLS), 'int_half_even')} AS slope_int FROM w"
SQL_TREND_SLOPE_LONG = _EV_WIDE + ",\ng AS (" + " UNION ALL ".join(
    f"SELECT id, {y} AS year, count_{y} AS n FROM w" for y in YEARS) + """)
SELECT id, round(regr_slope(CAST(n AS DOUBLE), CAST(year AS DOUBLE)), 9) AS slope FROM g GROUP BY id"""

# ------------------------------------------------------------- registry

REPORT_PRESETS = ("four_branch", "split_union", "either_side", "row_predicate",
                  "distinct_ticket", "side_unpivot", "canonical")

QUERIES: dict[str, Query] = {
    "valid_tickets_by_code": q_valid_tickets_by_code,
    "house_number_split": q_house_number_split,
    "segment_pair_split": q_segment_pair_split,
    "street_key_coalesce": q_street_key_coalesce,
    "reject_reasons": q_reject_reasons,
    "equi_join_counts": q_equi_join_counts,
    "either_name_join_counts": q_either_name_join_counts,
    "range_match_plain": q_range_match_plain,
    "range_match_compound": q_range_match_compound,
    "segment_side_unpivot": q_segment_side_unpivot,
    "branch_union_all": q_branch_union_all,
    "count_per_id_year": q_count_per_id_year,
    "yearly_pivot": q_yearly_pivot,
    "yearly_pivot_per_id_year": q_yearly_pivot_per_id_year,
    "yearly_pivot_absent_year": q_yearly_pivot_absent_year,
    "one_hot_vector_sum": q_one_hot_vector_sum,
    "spine_zero_fill": q_spine_zero_fill,
    "spine_union_zero": q_spine_union_zero,
    "distinct_id_ticket_year": q_distinct_id_ticket_year,
    "distinct_id_ticket": q_distinct_id_ticket,
    "trend_slope": q_trend_slope,
    "trend_slope_long": q_trend_slope_long,
    "trend_slope_int": q_trend_slope_int,
    "trend_slope_centred": q_trend_slope_centred,
}
ORACLES: dict[str, str] = {
    "valid_tickets_by_code": SQL_VALID_TICKETS,
    "house_number_split": SQL_HOUSE_NUMBER_SPLIT,
    "segment_pair_split": SQL_SEGMENT_PAIR_SPLIT,
    "street_key_coalesce": SQL_STREET_KEY_COALESCE,
    "reject_reasons": SQL_REJECT_REASONS,
    "equi_join_counts": SQL_EQUI_JOIN_COUNTS,
    "either_name_join_counts": SQL_EITHER_NAME_JOIN_COUNTS,
    "range_match_plain": _match_counts_sql(CANON, "hn_suffix IS NULL"),
    "range_match_compound": _match_counts_sql(CANON, "hn_suffix IS NOT NULL"),
    "segment_side_unpivot": SQL_SEGMENT_SIDE_UNPIVOT,
    "branch_union_all": _match_counts_sql(BRANCH_POLICY),
    "count_per_id_year": SQL_COUNT_PER_ID_YEAR,
    "yearly_pivot": SQL_YEARLY_PIVOT,
    "yearly_pivot_per_id_year": SQL_YEARLY_PIVOT_PER_ID_YEAR,
    "yearly_pivot_absent_year": f"SELECT *, CAST(0 AS BIGINT) AS count_{ABSENT_YEAR} FROM ({SQL_YEARLY_PIVOT})",
    "one_hot_vector_sum": SQL_YEARLY_PIVOT,
    "spine_zero_fill": SQL_SPINE_ZERO_FILL,
    "spine_union_zero": SQL_SPINE_ZERO_FILL,
    "distinct_id_ticket_year": _match_counts_sql(DEDUP_YEAR_POLICY),
    "distinct_id_ticket": _match_counts_sql(DEDUP_TICKET_POLICY),
    "trend_slope": SQL_TREND_SLOPE,
    "trend_slope_long": SQL_TREND_SLOPE_LONG,
    "trend_slope_int": SQL_TREND_SLOPE_INT,
    "trend_slope_centred": SQL_TREND_SLOPE_LONG,
}

for _name in REPORT_PRESETS:
    _pol = fixture_policy(_name)
    QUERIES[f"match_{_name}"] = _report_query(_pol)
    ORACLES[f"match_{_name}"] = O.report_sql(_pol)

FLAGSHIP_POLICY = CANON.with_(order_by_id=True)
QUERIES["report_sorted"] = _report_query(FLAGSHIP_POLICY)
ORACLES["report_sorted"] = O.report_sql(FLAGSHIP_POLICY)

# The path a large segment table takes: no broadcast (measured size over the
# bound), probes pre-aggregated map-side, sort-merge join on the four keys.
SHUFFLE_POLICY = CANON.with_(broadcast_max_bytes=0)
QUERIES["match_canonical_shuffle_join"] = _report_query(SHUFFLE_POLICY)
ORACLES["match_canonical_shuffle_join"] = O.report_sql(CANON)


def q_report_lines(spark, sf):
    """The text sink's line format: fields joined by ', '."""
    rep = segment_report(fixture_tickets(spark, sf), fixture_segments(spark, sf), CANON)
    return rep.select(F.concat_ws(", ", *[F.col(c).cast("string") for c in rep.columns]).alias("line"))


def q_report_count(spark, sf):
    """The count sink: number of report rows."""
    rep = segment_report(fixture_tickets(spark, sf), fixture_segments(spark, sf), CANON)
    return rep.agg(F.count(F.lit(1)).alias("n_rows"))


def q_long_house_numbers(spark, sf):
    """The canonical report over house numbers and ranges of up to 30 digits, zero-padded ones, and borough codes that
    are no numbers or too large."""
    return segment_report(fixture_long_tickets(spark, sf), fixture_long_segments(spark, sf), CANON)


QUERIES["long_house_numbers"] = q_long_house_numbers
ORACLES["long_house_numbers"] = O.report_sql(CANON, fixtures=O.LONG_FIXTURE_SQL)

def _spread_report(policy: MatchPolicy) -> Query:
    def run(spark, sf):
        return segment_report(fixture_spread_tickets(spark, sf), fixture_spread_segments(spark, sf), policy)
    return run


# the same presets where blocks differ, some sides span hundreds of them, and names decide by case or by alternative
QUERIES["match_canonical_wide_sides"] = _spread_report(CANON)
ORACLES["match_canonical_wide_sides"] = O.report_sql(CANON, fixtures=O.SPREAD_FIXTURE_SQL)
for _name in ("four_branch", "split_union"):
    _pol = fixture_policy(_name)
    QUERIES[f"match_{_name}_spread"] = _spread_report(_pol)
    ORACLES[f"match_{_name}_spread"] = O.report_sql(_pol, fixtures=O.SPREAD_FIXTURE_SQL)

# running counts along sorted house numbers instead of pairs, on sides of all widths and on numbers of any length
SWEEP_POLICY = CANON.with_(range_join="sweep")
QUERIES["match_canonical_sweep"] = _spread_report(SWEEP_POLICY)
ORACLES["match_canonical_sweep"] = O.report_sql(CANON, fixtures=O.SPREAD_FIXTURE_SQL)
BRANCH_SWEEP_POLICY = fixture_policy("four_branch", fold_case=True, range_join="sweep")
QUERIES["match_four_branch_sweep"] = _report_query(BRANCH_SWEEP_POLICY)
ORACLES["match_four_branch_sweep"] = O.report_sql(BRANCH_SWEEP_POLICY)


def q_long_house_numbers_sweep(spark, sf):
    return segment_report(fixture_long_tickets(spark, sf), fixture_long_segments(spark, sf), SWEEP_POLICY)


QUERIES["long_house_numbers_sweep"] = q_long_house_numbers_sweep
ORACLES["long_house_numbers_sweep"] = O.report_sql(CANON, fixtures=O.LONG_FIXTURE_SQL)

ROW_SHUFFLE_POLICY = fixture_policy("row_predicate", broadcast_max_bytes=0)  # the salted join of raw probes
QUERIES["match_row_predicate_shuffle_join"] = _report_query(ROW_SHUFFLE_POLICY)
ORACLES["match_row_predicate_shuffle_join"] = O.report_sql(fixture_policy("row_predicate"))


def q_csv_record_parse(spark, sf):
    """CSV text made from the tickets (quoted commas, doubled quotes), parsed with the reader's schema and options."""
    t = fixture_tickets(spark, sf)
    street = F.concat(F.lit('"'), F.col("street_name"), F.lit(', ""EAST"" "'))
    fields = {**{name: F.col(name) for name in TICKET_FIELDS.values()}, "street_name": street}
    line = F.concat_ws(",", *[F.coalesce(fields[TICKET_FIELDS[i]], F.lit("")) if i in TICKET_FIELDS else F.lit("")
                              for i in range(TICKET_WIDTH)])
    parsed = F.from_csv(line, TICKET_SCHEMA.simpleString()[7:-1].replace(":", " "), {"quote": '"', "escape": '"'})
    return t.select(parsed.alias("r")).select(*[F.col(f"r.{c}").alias(c) for c in TICKET_COLUMNS])


QUERIES["csv_record_parse"] = q_csv_record_parse
ORACLES["csv_record_parse"] = O.with_fixtures() + """
SELECT ticket_id, issue_date, county, nullif(house_number, '') AS house_number,
       street_name || ', "EAST" ' AS street_name FROM t0"""

def _scratch(spark, name: str) -> str:
    return f"{checkpoint_path(spark, name)}-{uuid.uuid4().hex}"


def _report_type() -> str:
    return "segment_id string, " + ", ".join(f"{c} bigint" for c in COUNT_COLS) + ", slope double"


#: Tickets in one written file, about.
FILE_TICKETS = 1_000_000
#: The ledger's files are fewer.
LEDGER_TICKETS = 10_000_000


def q_report_from_files(spark, sf):
    """Tickets and segments written as several CSV files with headers, read by glob; the report written as CSV and read
    back."""
    base = _scratch(spark, "csv-files")
    files = max(6, -(-table(spark, sf, "lineitem").count() // FILE_TICKETS))
    write_tickets_csv(fixture_tickets(spark, sf).repartition(files, "ticket_id"), f"{base}/violations")
    write_segments_csv(fixture_segments(spark, sf), f"{base}/centerline")
    tickets = read_tickets_csv(spark, f"{base}/violations/*.csv")
    write_report_csv(segment_report(tickets, read_segments_csv(spark, f"{base}/centerline"), CANON), f"{base}/report")
    return spark.read.schema(_report_type()).csv(f"{base}/report")


def q_report_sorted_files(spark, sf):
    """The report written in the order of its ids over several part files; ``position`` is each row's place in them."""
    path = _scratch(spark, "sorted-files")
    write_report_sorted(segment_report(fixture_tickets(spark, sf), fixture_segments(spark, sf), CANON), path)
    return sorted_rows(spark, path, _report_type()).select("position", "segment_id", "slope")


def q_report_by_ledger(spark, sf):
    """Ticket files counted one by one: those of three years first, then all; the second run reads only the new ones."""
    base = _scratch(spark, "ledger")
    tickets, segments = fixture_tickets(spark, sf), fixture_segments(spark, sf)
    known: set[str] = set()
    files = max(2, -(-table(spark, sf, "lineitem").count() // LEDGER_TICKETS))
    for years in (YEARS[:3], YEARS[3:]):
        part = tickets.where(year_suffix(F.col("issue_date")).isin([str(y) for y in years]))
        part = part.repartition(files, "ticket_id")  # all tasks make the files' rows
        part.select(*TICKET_COLUMNS).write.mode("append").parquet(f"{base}/tickets")
        found = refresh(spark, f"{base}/tickets/*.parquet", segments, CANON, f"{base}/counts", read=read_tickets_parquet)
        if not found.read or known & set(found.read):
            raise RuntimeError("a known file was read again")
        known |= set(found.read)
    return ledger_report(found, segments, CANON)


def q_reject_reasons_observed(spark, sf):
    """The reject counts that the report's own pass observes."""
    tickets, seen = observed_rejects(fixture_tickets(spark, sf), CANON)
    segment_report(tickets, fixture_segments(spark, sf), CANON).write.parquet(_scratch(spark, "observed"))
    return spark.createDataFrame([(r, n) for r, n in seen.get.items() if n], "reason string, n bigint")


def q_trend_slope_merged(spark, sf):
    """Regression sums of two halves of the events, made apart, merged, and the slope over the zero-filled grid."""
    events = _events(spark, sf)
    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    parts = [event_sums(events.where(half == k), "id", "year", YEARS) for k in (0, 1)]
    ids = fixture_spine(spark, sf).select("id").distinct()
    return ids.join(merged(parts, "id"), "id", "left").select("id", F.round(grid_slope(YEARS), 9).alias("slope"))


QUERIES |= {"report_from_files": q_report_from_files, "report_sorted_files": q_report_sorted_files,
            "report_by_ledger": q_report_by_ledger, "reject_reasons_observed": q_reject_reasons_observed,
            "trend_slope_merged": q_trend_slope_merged}
ORACLES |= {
    "report_from_files": O.report_sql(CANON),
    "report_sorted_files": f"SELECT row_number() OVER (ORDER BY segment_id) AS position, segment_id, slope FROM ({O.report_sql(CANON)})",
    "report_by_ledger": O.report_sql(CANON), "reject_reasons_observed": SQL_REJECT_REASONS,
    "trend_slope_merged": SQL_TREND_SLOPE_LONG}

_REPORT = O.report_sql(CANON)
QUERIES["report_lines"] = q_report_lines
ORACLES["report_lines"] = (f"SELECT concat_ws(', ', segment_id, {', '.join(CANON.count_columns)}, slope) AS line "
                           f"FROM ({_REPORT})")
QUERIES["report_count"] = q_report_count
ORACLES["report_count"] = f"SELECT count(*) AS n_rows FROM ({_REPORT})"

assert set(QUERIES) == set(ORACLES)
assert set(PRESETS) >= set(REPORT_PRESETS)
