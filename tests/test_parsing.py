import pytest
from pyspark.sql import functions as F

from curbline.functions.parsing import (
    LONG_NUMBER,
    at_most,
    long_key,
    borough_code,
    side_range,
    split_first_two,
    strict_int,
    strict_tuple,
    year_suffix,
)


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("125", 125), ("007", 7), ("0", 0), ("", None), (" 12", None), ("+7", None), ("12.5", None),
    ("12A", None), ("-5", None), ("12\n", None), ("9" * 18, int("9" * 18)), ("9" * 19, LONG_NUMBER), (None, None),
    ("0" * 18 + "5", 5), ("0" * 40, 0), ("0" * 30 + "9" * 18, int("9" * 18)), ("9" * 60, LONG_NUMBER), ("9" * 19 + "x", None),
])
def test_strict_int(spark, text, expected):
    assert one(spark, strict_int, text) == expected


@pytest.mark.parametrize("text,base,suffix", [
    ("70-23", "70", "23"), ("125", "125", None), ("71-", "71", ""), ("-5", "", "5"), ("25-3-1", "25", "3"),
])
def test_split_first_two(spark, text, base, suffix):
    row = (spark.createDataFrame([(text,)], "x string")
           .select(*[c.alias(n) for c, n in zip(split_first_two(F.col("x")), ("a", "b"))]).first())
    assert (row["a"], row["b"]) == (base, suffix)


@pytest.mark.parametrize("text,expected", [
    ("125", (125, 0)), ("70-23", (70, 23)), ("25-3-1", (25, 3)), ("71-", (None, None)),
    ("", (None, None)), ("A-1", (None, None)), (" 1", (None, None)),
])
def test_strict_tuple(spark, text, expected):
    row = (spark.createDataFrame([(text,)], "x string")
           .select(*[c.alias(n) for c, n in zip(strict_tuple(F.col("x")), ("a", "b"))]).first())
    assert (row["a"], row["b"]) == expected


@pytest.mark.parametrize("alias,full,short", [
    ("NY", 1, 1), ("NEW Y", 1, 1), ("BX", 2, 2), ("K", 3, 3), ("KING", 3, None), ("KINGS", 3, None),
    ("QNS", 4, 4), ("RICHMOND", 5, 5), ("ny", None, None), ("ZZ", None, None), ("KING,KINGS", None, None),
])
def test_borough_code(spark, alias, full, short):
    assert one(spark, lambda c: borough_code(c, "full"), alias) == full
    assert one(spark, lambda c: borough_code(c, "short"), alias) == short


def test_year_suffix(spark):
    assert one(spark, year_suffix, "06/14/2015") == "2015"
    assert one(spark, year_suffix, "") == ""


@pytest.mark.parametrize("mode,lo,hi,expected", [
    ("each", "70-01", "70-99", (70, 70, 1, 99)),
    ("each", "1", "99-9", (1, 99, None, 9)),
    ("pairwise", "70-01", "70-99", (70, 70, 1, 99)),
    ("pairwise", "1", "99-9", (1, None, None, None)),
    ("pairwise", "", "", (None, None, None, None)),
    ("strict_zero", "101", "199", (101, 199, 0, 0)),
    ("strict_zero", "1", "99-9", (1, 99, 0, 9)),
    ("strict_zero", "1", "", (None, None, None, None)),
])
def test_side_range(spark, mode, lo, hi, expected):
    df = spark.createDataFrame([(lo, hi)], "lo string, hi string")
    parts = side_range(F.col("lo"), F.col("hi"), mode)
    row = df.select(*[c.alias(f"c{i}") for i, c in enumerate(parts)]).first()
    assert tuple(row) == expected


@pytest.mark.parametrize("text", ["125", "70-23", "71-", "-5", "25-3-1", "7-A", "A-5", "12A", "", "1--2",
                                  "9" * 19 + "-1", "1-" + "9" * 19, " 1-2", "1-2 ", None])
def test_house_first_two_equals_split_then_strict(spark, text):
    from curbline.functions.parsing import house_first_two
    df = spark.createDataFrame([(text,)], "x string")
    a, b = split_first_two(F.col("x"))
    c, d = house_first_two(F.col("x"))
    row = df.select(strict_int(a).alias("a"), strict_int(b).alias("b"), c.alias("c"), d.alias("d")).first()
    assert (row["a"], row["b"]) == (row["c"], row["d"])


@pytest.mark.parametrize("split", ["first_two", "strict_tuple"])
def test_house_number_parses_equals_not_null(spark, split):
    from curbline.functions.parsing import house_number_parses
    from curbline.operators.tickets import house_number_parts
    texts = ["125", "70-23", "71-", "-5", "25-3-1", "7-A", "A-5", "12A", "", "1--2", " 1", "1 ", "+1",
             "9" * 18, "9" * 19, "9" * 19 + "-1", "1-" + "9" * 19, "12\n", "0", "00-00", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    hn, _ = house_number_parts(F.col("x"), split)
    rows = df.select("x", hn.isNotNull().alias("a"), F.coalesce(house_number_parses(F.col("x"), split),
                                                                F.lit(False)).alias("b")).collect()
    for r in rows:
        assert r["a"] == r["b"], (split, r["x"])


def test_house_suffix_parses_equals_suffix_not_null(spark):
    from curbline.functions.parsing import house_first_two, house_suffix_parses
    texts = ["125", "70-23", "71-", "-5", "25-3-1", "7-A", "A-5", "12A", "", "1--2", "1-2 ", "1- 2",
             "1-" + "9" * 18, "1-" + "9" * 19, "1-2-", "12\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    _, sfx = house_first_two(F.col("x"))
    for r in df.select("x", sfx.isNotNull().alias("a"),
                       F.coalesce(house_suffix_parses(F.col("x")), F.lit(False)).alias("b")).collect():
        assert r["a"] == r["b"], r["x"]


@pytest.mark.parametrize("low,high", [("5", "6"), ("0" * 30 + "5", "6"), ("9" * 18, "1" + "0" * 18), ("9" * 19, "1" + "0" * 19),
                                      ("7", "8" * 40), ("1" + "0" * 29, "1" + "0" * 28 + "1"), ("3" * 25, "0" + "3" * 25)])
def test_numbers_of_any_length_compare_exactly(spark, low, high):
    df = spark.createDataFrame([(low, high)], "a string, b string")

    def both(x, y):
        x, y = F.col(x), F.col(y)
        return at_most(strict_int(x), long_key(x), strict_int(y), long_key(y))

    assert df.select(both("a", "b")).first()[0] is True
    assert df.select(both("b", "a")).first()[0] is (int(low) == int(high))


def test_borough_codes_no_int_can_hold(spark):
    from curbline.operators.segments import borough_number
    assert one(spark, borough_number, "99999999999") is None
    assert one(spark, borough_number, "9" * 30) is None
    assert one(spark, borough_number, "3") == 3
