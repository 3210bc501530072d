"""What the gold build looks up and writes on the way."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from slotwise.catalog import features, views
from slotwise.operators import intervals, upsert
from slotwise.plans import gold

SF = "/root/testdata/sf0.001"


def test_points_are_asked_for_covered_arrivals_only(spark, monkeypatch):
    made = {}
    keep = gold.persist_table

    def noted(df, label):
        made[label] = keep(df, label)
        return made[label]

    monkeypatch.setattr(gold, "persist_table", noted)
    flights = views.silver_flights(spark, SF)
    rows = features.gold_table(spark, SF)
    assert rows.count() == flights.count()
    # The flights themselves are looked up; no table of their distinct keys is written and joined back.
    assert "cells" not in made
    got = {(r["icao"], r["at"]): r["weight"] for r in made["notice-points"].collect()}
    want = {}
    for f in flights.select("dep_icao", "arr_icao", "arr_iata", F.unix_micros("dep_scheduled_utc").alias("at")).collect():
        for place in {0: f.dep_icao, 1: f.arr_icao if f.arr_iata in views.MONITORED else None}.values():
            if place is not None:
                want[place, f["at"]] = want.get((place, f["at"]), 0) + 1
    assert got == want
    weights = {(r["icao"], r["at"]): r["weight"] for r in made["notice-features"].collect()}
    assert weights and all(want[k] == n for k, n in weights.items())


def test_points_keep_their_columns(spark):
    points = spark.createDataFrame([("p", 5, 2), ("p", 90_000_000, 7), ("q", 5, 1)], "place string, at long, w long")
    spans = spark.createDataFrame([("p", 0, 10, 1, 3.0), ("p", 1, 200_000_000, 1, 4.0)], "place string, a long, b long, n long, m double")
    got = intervals.stab(points, spans, "place", "at", "a", "b", ["n"], ["m"], ["w"]).collect()
    assert sorted(tuple(r) for r in got) == [("p", 5, 2, 4.0, 2), ("p", 90_000_000, 1, 4.0, 7)]


def test_a_first_build_writes_its_rows_once(spark, tmp_path, monkeypatch):
    written = []
    keep = upsert.persist_table
    monkeypatch.setattr(upsert, "persist_table", lambda df, label: written.append(label) or keep(df, label))
    flights = views.silver_flights(spark, SF)
    start, end = features.departure_range(flights)
    build = lambda since: gold.build_features(
        flights, views.silver_airports(spark, SF), views.silver_notams(spark, SF), since, end, features.OPTIONS
    )
    path = f"file://{tmp_path}/gold"
    gold.write_features(build(start), path)
    assert written == []
    before = sorted(map(tuple, spark.read.parquet(path).select("flight_iata", "notam_count_route").collect()))
    since = datetime.combine(end.date() - timedelta(days=3), datetime.min.time())
    days = [since.date() + timedelta(days=i) for i in range(4)]
    gold.write_features(build(since), path, days)
    assert written == ["upsert-merged"]
    assert sorted(map(tuple, spark.read.parquet(path).select("flight_iata", "notam_count_route").collect())) == before
