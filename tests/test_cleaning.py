"""Cleaning, leakage guards and training-row checks."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from slotwise.plans import cleaning
from slotwise.schemas import FORBIDDEN_FEATURES, GOLD_REGISTRY


@pytest.fixture(scope="module")
def gold_rows(spark):
    random.seed(11)
    start = datetime(2026, 4, 10)
    data = []
    for i in range(1000):
        delay = random.choice([0, 5, 20, 60, None]) if i else 20
        data.append(
            (f"F{i}", start + timedelta(hours=i), random.choice(["ALA", "ALA", "GUW", None]),
             f"X{i % 190}", random.choice(["KC", None]), random.choice(["landed", " Cancelled ", "diverted", None]) if i else "landed",
             None if i % 3 else "T1", delay, None if delay is None else delay > 15,
             random.choice([None, 100, 200]), random.choice([None, True, False]), None if i % 2 else 3,
             random.choice([None, 4.5]), "yes" if i % 2 else "no", 1 if i else 2)
        )
    schema = (
        "flight_iata string, dep_scheduled_utc timestamp, dep_iata string, arr_iata string, airline_iata string, "
        "status string, dep_terminal string, dep_delay_min int, is_delayed boolean, dep_elevation_ft int, "
        "has_restriction_arr boolean, notam_count_arr int, route_avg_delay_7d double, dep_scheduled_service string, almost int"
    )
    return spark.createDataFrame(data, schema).withColumn("updated_at", F.current_timestamp()).withColumn("x_int", F.lit(1))


def test_cleaned_table_has_no_null(spark, gold_rows):
    plan = cleaning.fit_cleaning(gold_rows, rolling_flags=True)
    clean = plan.transform(gold_rows)
    nulls = clean.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in clean.columns]).first().asDict()
    assert not any(nulls.values())
    assert clean.count() == gold_rows.where(
        "dep_delay_min is not null and coalesce(lower(trim(status)), '') not in ('cancelled', 'diverted')"
    ).count()
    assert "almost" in plan.near_constant and "almost" not in clean.columns
    assert not {"status", "updated_at", "flight_iata", "dep_terminal", "x_int"} & set(clean.columns)
    assert {"dep_terminal_missing", "route", "dep_iata_grp", "dep_hour_sin", "route_avg_delay_7d_missing"} <= set(clean.columns)
    row = clean.first()
    assert row["dep_scheduled_utc"].endswith("+00:00") and len(row["dep_scheduled_utc"]) == 25
    assert {r[0] for r in clean.select("notam_count_arr").distinct().collect()} == {0.0, 3.0}
    # No arrival airport reaches the minimum, so the grouped column holds one value only.
    assert "arr_iata_grp" in plan.constant and "arr_iata_grp" not in clean.columns


def test_plan_applies_to_new_rows(spark, gold_rows):
    plan = cleaning.fit_cleaning(gold_rows, fit_rows=gold_rows.where("dep_scheduled_utc < timestamp '2026-04-20'"))
    late = plan.transform(gold_rows.where("dep_scheduled_utc >= timestamp '2026-04-20'"))
    assert late.columns == plan.transform(gold_rows).columns and late.count() > 0


def test_errors(spark, gold_rows):
    with pytest.raises(ValueError):
        cleaning.labelled_rows(gold_rows.drop("is_delayed"))
    with pytest.raises(ValueError):
        cleaning.fit_cleaning(gold_rows.where("dep_delay_min is null"))


def test_column_medians(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, None), (4, None), (None, None)], "a int, b double")
    assert cleaning.column_medians(df, ["a", "b"]) == {"a": 2.5, "b": 0.0}


def test_leakage_guards(spark, gold_rows):
    columns = [*GOLD_REGISTRY, "route", "route_grp", "dep_iata_grp", "is_delayed_int", "extra_int"]
    drops = cleaning.leakage_drops(columns)
    assert set(drops["forbidden"]) == set(FORBIDDEN_FEATURES) - {"updated_at"}
    assert drops["raw_with_group"] == ["dep_iata", "route"]
    assert drops["helper_int"] == ["extra_int"]
    with pytest.raises(ValueError):
        cleaning.check_no_leakage(["dep_hour", "status"])
    features = cleaning.prepare_features(cleaning.fit_cleaning(gold_rows).transform(gold_rows))
    assert not set(features.features) & set(FORBIDDEN_FEATURES)
    cleaning.check_no_leakage(features.features)
    assert "dep_iata_grp" in features.categorical and "dep_hour" in features.numeric


def test_bool_like_text_becomes_numeric(spark):
    df = spark.createDataFrame(
        [(0, 1.0, "2026-04-10 00:00:00+00:00", "t", "a"), (1, 20.0, "2026-04-11 00:00:00+00:00", " False", "b")] * 3,
        "is_delayed int, dep_delay_min double, dep_scheduled_utc string, flag string, word string",
    )
    features = cleaning.prepare_features(df)
    assert features.numeric == ["flag"] and features.categorical == ["word"]


@pytest.mark.parametrize(
    "rows, fails",
    [
        ([("1", "20", "2026-04-10"), ("0", "3", "2026-04-11")], False),
        ([("1", "20", "2026-04-10"), ("1", "30", "2026-04-11")], True),
        ([("1", "20", "2026-04-10"), ("0", "-3", "2026-04-11")], True),
        ([("1", "20", "2026-04-10"), ("0", "x", "2026-04-11")], True),
        ([("1", "20", "2026-04-10"), ("0", "3", "soon")], True),
    ],
)
def test_validate_training_rows(spark, rows, fails):
    df = spark.createDataFrame(rows, "is_delayed string, dep_delay_min string, dep_scheduled_utc string")
    if fails:
        with pytest.raises(ValueError):
            cleaning.validate_training_rows(df)
    else:
        assert cleaning.validate_training_rows(df)["rows"] == 2
