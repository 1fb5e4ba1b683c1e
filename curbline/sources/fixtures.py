"""Ticket and segment tables derived from the TPC-H-like test tables.

The derivation is specified in FIXTURES.md section 4; the DuckDB oracle in
``curbline.plans.oracle`` derives the same rows in SQL. Years 1995-1999 play
the part of the five-year window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIXTURE_YEARS = (1995, 1996, 1997, 1998, 1999)

# Fixed values of the fixture specification: the county text of a ticket is
# element (l_orderkey mod 20) of this list; ZZ is an unknown alias.
COUNTY_CYCLE = (
    "MAN", "MH", "MN", "NEWY", "NEW Y", "NY", "BRONX", "BX", "BK", "K",
    "KING", "KINGS", "Q", "QN", "QNS", "QU", "QUEEN", "R", "RICHMOND", "ZZ",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rebalanced(df: DataFrame, key: str) -> DataFrame:
    """Spread an under-partitioned input over the cluster's cores.

    A single large row group is read by one task, and every narrow operator
    after it would run in that task too. When the input has fewer partitions
    than there are cores, a hash repartition on a high-cardinality ``key``
    right after the scan parallelises the per-row work. (Hash, not
    round-robin: round-robin sorts every row first to stay deterministic on
    retry.) Inputs that are already split, the normal case for large data,
    are returned unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df.rdd.getNumPartitions()
    return df.repartition(cores, key) if parts < cores else df


def fixture_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to part: one ticket per line item (raw text fields)."""
    li = rebalanced(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate"
    ), "l_orderkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    qty = F.col("l_quantity").cast("bigint").cast("string")
    house = (
        F.when(F.col("l_suppkey") % 10 == 0,
               F.concat(qty, F.lit("-"), ((F.col("l_partkey") % 50) + 1).cast("string")))
        .when(F.col("l_suppkey") % 10 == 1, F.lit("ABC"))
        .when(F.col("l_suppkey") % 10 == 2, F.concat(qty, F.lit("A")))
        .when(F.col("l_suppkey") % 10 == 3, F.lit(""))
        .otherwise(qty)
    )
    counties = F.array(*[F.lit(c) for c in COUNTY_CYCLE])
    return (
        li.join(part, li.l_partkey == part.p_partkey, "inner")
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("ticket_id"),
            F.date_format("l_shipdate", "MM/dd/yyyy").alias("issue_date"),
            F.element_at(counties, (F.col("l_orderkey") % 20 + 1).cast("int")).alias("county"),
            house.alias("house_number"),
            F.upper("p_name").alias("street_name"),
        )
    )


def fixture_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One street segment per part row (raw text fields)."""
    p = rebalanced(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), "p_partkey")
    k = F.col("p_partkey")
    b = (F.col("p_size") % 40).cast("bigint")
    compound = k % 4 == 0
    lo_txt, hi_txt = b.cast("string"), (b + 10).cast("string")
    full = (F.when(k % 11 == 0, F.lit(""))
            .when(k % 7 == 0, F.concat(F.lit("alt "), "p_name"))
            .otherwise(F.col("p_name")))
    label = (F.when((k % 11 == 0) | (k % 7 == 0), F.col("p_name"))
             .when(k % 3 == 0, F.concat(F.lit("alt "), "p_name"))
             .otherwise(F.col("p_name")))
    no_right = k % 13 == 0
    return p.select(
        k.cast("string").alias("segment_id"),
        F.when(compound, F.concat(lo_txt, F.lit("-01"))).otherwise(lo_txt).alias("l_low"),
        F.when(compound, F.concat(hi_txt, F.lit("-49"))).otherwise(hi_txt).alias("l_high"),
        F.when(no_right, F.lit("")).when(compound, F.concat(lo_txt, F.lit("-02")))
        .otherwise(lo_txt).alias("r_low"),
        F.when(no_right, F.lit("")).when(compound, F.concat(hi_txt, F.lit("-50")))
        .otherwise(hi_txt).alias("r_high"),
        label.alias("street_label"),
        ((k % 5) + 1).cast("string").alias("boro_code"),
        full.alias("full_street"),
        F.col("p_name").alias("alt_label"),
    )


def fixture_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, year) events for the count/trend operators: all orders of the window, per customer."""
    return (
        table(spark, sf_dir, "orders")
        .where(F.year("o_orderdate").between(FIXTURE_YEARS[0], FIXTURE_YEARS[-1]))
        .select(F.col("o_custkey").cast("string").alias("id"),
                F.year("o_orderdate").alias("year"),
                F.col("o_orderkey").cast("string").alias("event_id"))
    )


def fixture_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spine of the count/trend operators: all customer ids, and all supplier keys under ids of their own (no
    order bears those, so zero rows exist at every size)."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    suppliers = table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("id"))
    return customers.union(suppliers)


_PLAIN = r"^[0-9]+\z"


def _longer(number, kind):
    """A plain number as it is, zero-padded to 30 digits, with 20 zeros behind, or as 1, 19 digits; other text as is."""
    return (F.when(~number.rlike(_PLAIN) | (kind == 0), number)
            .when(kind == 1, F.lpad(number, 30, "0"))
            .when(kind == 2, F.concat(number, F.lit("0" * 20)))
            .otherwise(F.concat(F.lit("1"), F.lpad(number, 19, "0"))))


def _settled(df: DataFrame, **columns) -> DataFrame:
    """Replaces columns by a generator, so that their expressions are evaluated once a row, not wherever they're used."""
    kept = [c for c in df.columns if c not in columns]
    made = F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select(*kept, made).select(*df.columns)


def fixture_long_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tickets with house numbers of up to 30 digits."""
    t = fixture_tickets(spark, sf_dir)
    t = _settled(t, house_number=F.col("house_number"))
    return _settled(t, house_number=_longer(F.col("house_number"), F.col("ticket_id").cast("bigint") % 4))


def fixture_long_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments with range ends of up to 30 digits, and some impossible borough codes."""
    s = fixture_segments(spark, sf_dir)
    k = F.col("segment_id").cast("bigint")
    ends = {c: _longer(F.col(c), k % 4) for c in ("l_low", "l_high", "r_low", "r_high")}
    # one segment in eight reaches from a short number to a long one
    ends["l_high"] = F.when(k % 8 == 5, F.concat(F.col("l_high"), F.lit("0" * 20))).otherwise(ends["l_high"])
    boro = (F.when(k % 17 == 0, F.lit("99999999999")).when(k % 19 == 0, F.lit("X")).when(k % 23 == 0, F.lit("9" * 25))
            .otherwise(F.col("boro_code")))
    return _settled(_settled(s, **{c: F.col(c) for c in ends}), **ends, boro_code=boro)


def fixture_spread_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tickets with plain house numbers spread over about a thousand."""
    t = fixture_tickets(spark, sf_dir)
    t = _settled(t, house_number=F.col("house_number"))
    n, shift = F.col("house_number"), F.col("ticket_id").cast("bigint") % 20 * 50
    return _settled(t, house_number=F.when(n.rlike(_PLAIN), (n.cast("bigint") + shift).cast("string")).otherwise(n))


def fixture_spread_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments spread likewise; some sides span hundreds of blocks, half the full names are in the tickets' case,
    a third of the alternative labels are other names, some ids are empty."""
    s = fixture_segments(spark, sf_dir)
    k = F.col("segment_id").cast("bigint")

    def moved(end: str, more):
        c = F.col(end)
        return F.when(c.rlike(_PLAIN), (c.cast("bigint") + k % 20 * 50 + more).cast("string")).otherwise(c)

    wide = F.when(k % 29 == 0, 20_000).when(k % 5 == 0, 150).otherwise(0)
    return _settled(_settled(s, **{c: F.col(c) for c in ("l_low", "l_high", "r_low", "r_high")}), **{
        "l_low": moved("l_low", F.lit(0)), "r_low": moved("r_low", F.lit(0)),
        "l_high": moved("l_high", wide), "r_high": moved("r_high", wide),
        "full_street": F.when(k % 2 == 0, F.upper("full_street")).otherwise(F.col("full_street")),
        "alt_label": F.when(k % 3 == 0, F.concat(F.lit("old "), "alt_label")).otherwise(F.col("alt_label")),
        "segment_id": F.when(k % 31 == 0, F.lit("")).otherwise(F.col("segment_id")),
    })
