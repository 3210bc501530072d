"""Literal cases for every scalar rule."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from slotwise.functions import casts, geo, rules, times
from slotwise.sources.worklist import date_chunks, extract_plan


def one(spark, column_of, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(column_of(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("", None),
        (None, None),
        ("x", None),
        ("2026-04-10t00:05:00.000", datetime(2026, 4, 10, 0, 5)),
        ("2026-04-10T05:05:00+05:00", datetime(2026, 4, 10, 0, 5)),
        ("2026-04-10 07:00", datetime(2026, 4, 10, 7)),
    ],
)
def test_utc_timestamp(spark, text, expected):
    micros = one(spark, lambda c: F.unix_micros(casts.utc_timestamp(c)), text)
    wanted = None if expected is None else int((expected - datetime(1970, 1, 1)).total_seconds() * 1e6)
    assert micros == wanted


@pytest.mark.parametrize("text, expected", [("12", 12), ("", None), ("5.0", None), ("abc", None), (" 7 ", 7)])
def test_strict_int(spark, text, expected):
    assert one(spark, casts.strict_int, text) == expected


@pytest.mark.parametrize("json, expected", [("12.7", 12), ('"5.0"', None), ('"7"', 7), ('""', None), ("null", None)])
def test_variant_int(spark, json, expected):
    assert one(spark, lambda c: casts.variant_int(F.parse_json(c)), json) == expected


@pytest.mark.parametrize(
    "text, expected", [(" Yes ", 1), ("T", 1), ("f", 0), ("NO", 0), ("maybe", None), (None, None)]
)
def test_bool_word(spark, text, expected):
    assert one(spark, casts.bool_word, text) == expected


def test_bool_like_passes_numbers_through(spark):
    assert one(spark, lambda c: casts.bool_like(c, "int"), 2, "int") == 2
    assert one(spark, lambda c: casts.bool_like(c, "boolean"), True, "boolean") == 1


@pytest.mark.parametrize("text, expected", [("True", 1), ("f", 0), ("1", 1), ("yes", None)])
def test_binary_target(spark, text, expected):
    assert one(spark, lambda c: casts.binary_target(c, "string"), text) == expected


def test_yes_flag_and_codes(spark):
    assert one(spark, casts.yes_flag, " YES") is True
    assert one(spark, casts.yes_flag, None) is False
    assert one(spark, casts.trimmed_code, "  ") is None
    assert one(spark, casts.upper_code, "ab ") == "AB "
    assert one(spark, casts.number, "NaN") is None
    assert one(spark, casts.nan_to_null, float("nan"), "double") is None


@pytest.mark.parametrize(
    "dep, arr, expected",
    [("KZ", "KZ", True), ("KZ", "RU", False), (None, "KZ", False), (None, None, False)],
)
def test_domestic(spark, dep, arr, expected):
    df = spark.createDataFrame([(dep, arr)], "a string, b string")
    assert df.select(geo.is_domestic(F.col("a"), F.col("b"))).first()[0] is expected


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 90.0), (None, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(geo.haversine_km(*[F.col(c) for c in "abcd"])).collect()]
    assert got == [10007.54, None]


def test_season_and_weekend(spark):
    days = [(datetime(2026, m, 1),) for m in range(1, 13)]
    df = spark.createDataFrame(days, "t timestamp")
    got = [r[0] for r in df.select(times.season(F.col("t"))).collect()]
    assert got == ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["autumn"] * 3 + ["winter"]
    saturday = spark.createDataFrame([(datetime(2026, 4, 11),)], "t timestamp")
    assert saturday.select(times.is_weekend(F.col("t"))).first()[0] is True


def test_duration_is_never_negative(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 1, 3), datetime(2026, 1, 1, 1))], "a timestamp, b timestamp")
    row = df.select(times.duration_hours(F.col("a"), F.col("b")), times.duration_hours(F.col("b"), F.col("a"))).first()
    assert list(row) == [0.0, 2.0]


@pytest.mark.parametrize(
    "text, flags",
    [
        ("RWY CLSD due works", {"runway_closed"}),
        ("Runway Closed", {"runway_closed"}),
        ("MILITARY and parachute", {"military", "parachute"}),
        ("Restricted Area", {"restriction"}),
        (None, set()),
    ],
)
def test_text_flags(spark, text, flags):
    got = {n for n, p in rules.TEXT_FLAGS.items() if one(spark, lambda c: rules.text_flag(c, p), text)}
    assert got == flags


@pytest.mark.parametrize("p, band", [(0.3499, "low"), (0.35, "medium"), (0.6499, "medium"), (0.65, "high")])
def test_risk_band(spark, p, band):
    assert one(spark, rules.risk_band, p, "double") == band


def test_top_factors_keeps_the_first_five(spark):
    df = spark.createDataFrame(
        [(True, 2000.0, 9, 9, 9, "yes", 9), (None, None, None, None, None, None, None)],
        "is_international boolean, route_distance_km double, notam_count_route int, flights_dep_same_hour int, "
        "flights_arr_same_hour int, has_airspace_restriction string, notam_count_dep int",
    )
    got = [r[0] for r in df.select(rules.top_factors(dict(df.dtypes))).collect()]
    assert got[0] == [
        "international flight", "long route distance", "many route NOTAMs",
        "departure airport congestion", "arrival/departure airport congestion",
    ]
    assert got[1] == []


def test_error_type_and_two_stage(spark):
    df = spark.createDataFrame([(1, 0, 5.0), (0, 1, -3.0), (1, 1, 7.0)], "y int, q int, m double")
    got = df.select(rules.error_type(F.col("y"), F.col("q")), rules.two_stage_minutes(F.col("q"), F.col("m"))).collect()
    assert [tuple(r) for r in got] == [("false_negative", 0.0), ("false_positive", 0.0), ("correct", 7.0)]


def test_date_chunks(spark):
    got = [tuple(r) for r in date_chunks(spark, date(2026, 4, 10), date(2026, 5, 10), 7).orderBy("chunk_from").collect()]
    assert len(got) == 5
    assert got[0] == (date(2026, 4, 10), date(2026, 4, 16))
    assert got[-1] == (date(2026, 5, 8), date(2026, 5, 10))
    assert date_chunks(spark, date(2026, 5, 2), date(2026, 5, 1), 7).count() == 0


def test_extract_plan(spark):
    airports = spark.createDataFrame([("ALA",), ("GUW",)], "code string")
    plan = extract_plan(airports, "code", ["departure", "arrival"], date(2026, 4, 10), date(2026, 5, 10), 7)
    assert plan.count() == plan.distinct().count() == 2 * 2 * 5
