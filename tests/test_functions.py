import datetime as dt

import pytest
from pyspark.sql import functions as F

from zonalis.functions import dates, geo, names, prices, values
from tests.conftest import rows


def col(spark, data, ddl, expr):
    return [r[0] for r in spark.createDataFrame(data, ddl).select(expr.alias("x")).collect()]


def test_missing_to_null(spark):
    df = spark.createDataFrame(
        [(float("nan"), "nan"), (float("inf"), "NaT"), (-float("inf"), "None"), (1.5, "inf"),
         (None, "-inf"), (0.0, "x"), (2.0, None)], "a double, b string")
    assert [tuple(r) for r in values.missing_to_null(df).collect()] == [
        (None, None), (None, None), (None, None), (1.5, None), (None, None), (0.0, "x"), (2.0, None)]


def test_bounded_int_truncates_before_comparing(spark):
    texts = [("12",), ("13",), ("12.9",), ("-0.5",), ("abc",), ("1e12",), ("NaN",), ("inf",),
             ("1e300",), (None,), ("0",)]
    got = col(spark, texts, "x string", values.bounded_int(F.col("x"), 0, 12))
    assert got == [12, None, 12, 0, None, None, None, None, None, None, 0]


def test_with_bounded_ints_on_whole_numbers(spark):
    df = spark.createDataFrame([(51, "7.9"), (50, "x"), (None, "51")], "dormitorios bigint, banos string")
    got = values.with_bounded_ints(df, {"dormitorios": (0, 50), "banos": (0, 50)})
    assert got.dtypes == [("dormitorios", "int"), ("banos", "int")]
    assert [tuple(r) for r in got.collect()] == [(None, 7), (50, None), (None, None)]


def test_clamp_keeps_null(spark):
    got = col(spark, [(-5.0,), (0.5,), (9.0,), (None,)], "x double", values.clamp(F.col("x"), -2.0, 2.0))
    assert got == [-2.0, 0.5, 2.0, None]


def test_ratio_by_zero_is_null(spark):
    assert col(spark, [(1.0, 0.0), (1.0, 4.0), (None, 2.0)], "a double, b double",
               values.ratio(F.col("a"), F.col("b"))) == [None, 0.25, None]


@pytest.mark.parametrize("kind,data,want", [
    ("string", ["2015", "x", None, "2030", "2001-05-06"], [2015, None, None, 2030, 2001]),
    ("int", [2015, None], [2015, None])])
def test_construction_year(spark, kind, data, want):
    got = col(spark, [(v,) for v in data], f"x {kind}", dates.construction_year(F.col("x")))
    assert got == want


def test_age_has_floor_zero(spark):
    got = col(spark, [(2015,), (2030,), (None,)], "x int", dates.age_years(F.col("x"), "2026-03-01"))
    assert got == [11, 0, None]


def test_days_on_market_takes_first_known_end(spark):
    d = dt.datetime
    data = [
        (d(2024, 1, 1), d(2024, 1, 11), d(2024, 1, 3), d(2024, 1, 4)),  # sold
        (d(2024, 1, 1), None, d(2024, 1, 3), d(2024, 1, 4)),            # cancelled
        (d(2024, 1, 1), None, None, d(2024, 1, 4)),                     # contract end
        (d(2024, 1, 1), None, None, None),                              # still listed
        (d(2024, 1, 10), d(2024, 1, 2), None, None),                    # sold before listing
        (None, d(2024, 1, 2), None, None),
        (d(2024, 1, 1, 18), d(2024, 1, 3, 6), None, None),              # whole days only
    ]
    got = col(spark, data, "a timestamp_ntz, b timestamp_ntz, c timestamp_ntz, d timestamp_ntz",
              dates.days_on_market(F.col("a"), F.col("b"), F.col("c"), F.col("d"), "2024-02-01"))
    assert got == [10, 2, 3, 31, 0, None, 1]


def test_in_years_is_a_range(spark):
    d = dt.datetime
    data = [(d(2023, 12, 31, 23, 59),), (d(2024, 1, 1),), (d(2025, 6, 1),), (d(2027, 1, 1),), (None,)]
    got = col(spark, data, "x timestamp_ntz", dates.in_years(F.col("x"), (2024, 2026, 2025)))
    assert got == [False, True, True, False, None]


def test_in_last_months(spark):
    d = dt.datetime
    data = [(d(2024, 7, 31, 23),), (d(2024, 8, 1),)]
    got = col(spark, data, "x timestamp_ntz", dates.in_last_months(F.col("x"), 6, "2025-02-01"))
    assert got == [False, True]


def test_safe_timestamp(spark):
    got = col(spark, [("2024-05-06",), ("no",), (None,)], "x string", dates.safe_timestamp(F.col("x")))
    assert got == [dt.datetime(2024, 5, 6), None, None]


def test_price_per_m2(spark):
    data = [
        ("Penthouse", 50.0, 100.0, 1000.0, 9.0),   # department: built area
        ("Casa", 50.0, 100.0, 1000.0, 9.0),        # other: total area
        ("Casa", 50.0, 100.0, None, 500.0),        # no closing price
        ("Casa", 50.0, 100.0, 0.0, 500.0),         # closing price 0
        ("Casa", 50.0, 100.0, -1.0, 500.0),        # negative is no price
        ("Casa", 50.0, 0.0, 10.0, 10.0), ("Casa", 50.0, None, 10.0, 10.0),
        (None, 50.0, 20.0, 10.0, 10.0),
    ]
    got = col(spark, data, "s string, b double, t double, c double, l double", prices.price_per_m2(
        prices.is_department(F.col("s"), ["penthouse"]), *[F.col(c) for c in "btcl"]))
    assert got == [20.0, 10.0, 5.0, 5.0, None, None, None, 0.5]


def test_relative_difference(spark):
    got = col(spark, [(3.0, 2.0), (3.0, 0.0), (3.0, None), (None, 2.0)], "p double, m double",
              prices.relative_difference(F.col("p"), F.col("m")))
    assert got == [0.5, 0.0, 0.0, None]


def test_price_band(spark):
    low, high = prices.price_band(F.lit(100.0), 0.12)
    assert col(spark, [(1,)], "x int", low) == [88.0] and col(spark, [(1,)], "x int", high) == [112.0]


def test_names(spark):
    got = col(spark, [(" A; B ,c",), (None,), ("\tX\n",)], "x string", names.names_from_text(F.col("x")))
    assert got == [["a", "b", "c"], [], ["x"]]
    got = col(spark, [([" Av. A", "B;C"],), (None,)], "x array<string>", names.names_from_list(F.col("x")))
    assert got == [["av. a", "b;c"], []]
    assert col(spark, [(["a", "b"],), (None,)], "x array<string>", names.joined_names(F.col("x"))) == ["a, b", ""]


LINE = "g array<struct<lng:double,lat:double>>"


def test_line_centroid_and_bounds(spark):
    lines = [
        ([(0.0, 0.0), (4.0, 0.0), (4.0, 2.0)],),  # weights 4 and 2
        ([(1.0, 5.0), (1.0, 5.0)],),              # no length
        ([(7.0, 8.0)],), ([],), (None,)]
    df = spark.createDataFrame(lines, LINE)
    got = [r[0] and tuple(r[0]) for r in df.select(geo.line_centroid(F.col("g"))).collect()]
    assert got[0] == pytest.approx((16 / 6, 2 / 6))
    assert got[1:] == [(1.0, 5.0), (7.0, 8.0), None, None]
    bounds = df.select(*[c.alias(n) for n, c in geo.line_bounds(F.col("g")).items()]).first()
    assert bounds.asDict() == {"lng_min": 0.0, "lng_max": 4.0, "lat_min": 0.0, "lat_max": 2.0}


def test_multi_line_points(spark):
    df = spark.createDataFrame([([[(0.0, 1.0)], [(2.0, 3.0)]],)], "g array<array<struct<lng:double,lat:double>>>")
    assert [tuple(p) for p in df.select(geo.multi_line_points(F.col("g"))).first()[0]] == [(0.0, 1.0), (2.0, 3.0)]


def test_null_or_rows_helper(spark):
    assert rows(spark.createDataFrame([(2,), (None,)], "a int")) == [(2,), (None,)]
