"""Landing, flattening, promotion and the gold build on literal rows."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from slotwise.operators.upsert import replay
from slotwise.plans import gold, silver
from slotwise.schemas import GOLD_REGISTRY
from slotwise.sources import envelope, incremental, snapshot
from slotwise.streaming import landing, promotion


def flight(number, when, delay=None, terminal=None, status="landed", **more):
    return {
        "status": status,
        "flight": {"iataNumber": number, "number": "12"},
        "departure": {"iataCode": "ala", "scheduledTime": when, "delay": delay, "terminal": terminal},
        "arrival": {"iataCode": "", "scheduledTime": None},
        **more,
    }


def message(payload, **more):
    return json.dumps(
        {"ingestion_ts_utc": "2026-04-10T00:00:00+00:00", "queried_airport": "ALA", "query_direction": "departure",
         "chunk_from": "2026-04-10", "chunk_to": "2026-04-16", "source": "feed", "payload": payload, **more}
    )


def raw_rows(spark, payloads):
    return spark.createDataFrame(
        [(i, json.dumps(p) if not isinstance(p, str) else p) for i, p in enumerate(payloads)], "id long, payload string"
    ).selectExpr(
        "*", "'ALA' AS queried_airport", "date '2026-04-10' AS chunk_from", "date '2026-04-16' AS chunk_to",
        "'feed' AS source", "timestamp '2026-04-10 00:00:00' AS ingestion_ts_utc",
    )


def test_flatten_flights_quirks(spark):
    rows = raw_rows(
        spark,
        [
            flight("kc1", "2026-04-10t08:00:00.000", "5"),
            flight("kc1", "2026-04-10t08:00:00.000", None, status="active"),
            flight("", "2026-04-10t08:00:00.000", 5),
            flight("kc2", "not a time", 5),
            flight("kc3", "2026-04-10T09:00:00.000", 7.9),
            flight("kc4", "2026-04-10T09:00:00.000", "7.9"),
            {"flight": None},
        ],
    )
    got = {r["flight_iata"]: r for r in silver.latest_flights(rows, ["id"]).collect()}
    assert set(got) == {"KC1", "KC3", "KC4"}
    assert got["KC1"]["dep_delay_min"] is None and got["KC1"]["status"] == "active"
    assert got["KC1"]["dep_iata"] == "ALA" and got["KC1"]["arr_iata"] is None
    assert got["KC3"]["dep_delay_min"] == 7 and got["KC4"]["dep_delay_min"] is None


def test_flatten_notams(spark):
    rows = raw_rows(
        spark,
        [
            {"number": " a1/26 ", "location": "uaaa", "class": "I", "startdateutc": "2026-04-10T00:00:00Z",
             "enddateutc": "", "condition": "old"},
            {"number": "A1/26", "location": "uaaa", "startdateutc": "2026-04-10T00:00:00Z", "condition": "new"},
            {"number": "  ", "location": "x"},
        ],
    )
    got = silver.latest_notams(rows, ["id"]).collect()
    assert len(got) == 1
    assert (got[0]["notam_number"], got[0]["location_icao"], got[0]["condition_text"], got[0]["end_utc"]) == (
        "A1/26", "UAAA", "new", None,
    )


def test_decode_separates_bad_messages(spark):
    values = [message(flight("kc1", "2026-04-10T08:00:00")), "{broken", "[1]", "", message({"new_field": {"a": [1, 2]}}),
              '{"source": "bare"}']
    df = spark.createDataFrame([(v,) for v in values], "value string")
    good, bad = envelope.split_decoded(envelope.decode(df, envelope.FLIGHT_PROVENANCE))
    assert sorted(r["value"] for r in bad.collect()) == ["", "[1]", "{broken"]
    payloads = [r["payload"] for r in good.collect()]
    assert any("new_field" in p for p in payloads) and "{}" in payloads
    first = good.where("queried_airport = 'ALA'").first()
    assert str(first["chunk_from"]) == "2026-04-10" and first["ingestion_ts_utc"] is not None


def test_routing_keys(spark):
    import hashlib

    p = spark.createDataFrame([(json.dumps(flight("", None)),)], "j string").select(
        F.from_json("j", "flight struct<iataNumber string>, departure struct<scheduledTime string>, number string").alias("p")
    )
    got = p.select(envelope.flight_key(F.col("p")), envelope.notam_key(F.col("p"), F.lit("ALA"))).first()
    assert got[0] == hashlib.md5(b"unknown|unknown").hexdigest()
    assert got[1] == hashlib.md5(b"ALA|unknown").hexdigest()


def test_envelope_roundtrip(spark):
    df = spark.createDataFrame([("2026-04-10T00:00:00+00:00", "ALA", "departure", "2026-04-10", "2026-04-16", "feed")],
                               ", ".join(f"{c} string" for c in envelope.FLIGHT_PROVENANCE))
    wrapped = envelope.wrap(df.withColumn("p", F.struct(F.lit("1").alias("a"))), "p", envelope.FLIGHT_PROVENANCE, F.lit("k"))
    good, bad = envelope.split_decoded(envelope.decode(wrapped.select("value"), envelope.FLIGHT_PROVENANCE))
    assert bad.count() == 0 and good.first()["payload"] == '{"a":"1"}'


CSV_HEADER = (
    "id,ident,type,name,latitude_deg,longitude_deg,elevation_ft,continent,iso_country,iso_region,municipality,"
    "scheduled_service,gps_code,icao_code,iata_code,local_code,home_link,wikipedia_link,keywords,extra"
)


def test_airport_snapshot_is_loaded_once(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "airports 1.csv").write_text(
        CSV_HEADER + '\n1,AA,large_airport,"Big ""A"" field",43.3,77.0,2234,AS,KZ,KZ-ALA,"Line one\nline two",yes,,uaaa , ala,,,,,z\n'
        "2,BB,heliport,H,1,1,1,AS,KZ,KZ-X,M,no,,,hhh,,,,,z\n"
        "3,NA,small_airport,N,bad,,7.6,NA,NA,NA-1,M,no,,, ,,,,,z\n"
        "4,CC,small_airport,C,bad,,7.6,NA,NA,NA-1,M,no,,,ccc,,,,,z\n"
    )
    table = str(tmp_path / "raw")
    assert snapshot.load_airport_snapshots(spark, str(folder), table) == {"files": 1, "inserted": 4}
    assert snapshot.load_airport_snapshots(spark, str(folder), table) == {"files": 0, "inserted": 0}
    raw = spark.read.parquet(table)
    first = raw.where("ourairports_id = '1'").first()
    assert first["name"] == 'Big "A" field' and first["municipality"] == "Line one\nline two"
    assert first["gps_code"] is None and first["source_file"] == "airports 1.csv"
    clean = {r["iata_code"]: r for r in silver.latest_airports(raw, ["ourairports_id"]).collect()}
    assert set(clean) == {"ALA", "CCC"}
    assert clean["ALA"]["icao_code"] == "UAAA" and clean["ALA"]["scheduled_service"] is True
    assert clean["CCC"]["iso_country"] == "NA" and clean["CCC"]["latitude_deg"] is None
    assert clean["CCC"]["elevation_ft"] == 7


def test_snapshots_with_another_order_of_columns(spark, tmp_path):
    names = CSV_HEADER.split(",")
    (tmp_path / "a.csv").write_text(CSV_HEADER + "\n" + ",".join(f"{n}-a" for n in names) + "\n")
    (tmp_path / "b.csv").write_text(",".join(names[::-1]) + "\n" + ",".join(f"{n}-b" for n in names[::-1]) + "\n")
    rows = {r["source_file"]: r for r in snapshot.read_airport_csv(spark, str(tmp_path)).collect()}
    for name in ("a", "b"):
        assert rows[f"{name}.csv"]["iata_code"] == f"iata_code-{name}"
        assert rows[f"{name}.csv"]["ourairports_id"] == f"id-{name}"


def test_key_parts_stay_as_the_table_was_made(spark, tmp_path):
    table = str(tmp_path / "notices")
    assert promotion.key_parts(spark, table, 5) == 5
    spark.range(3).selectExpr("id", "'1_of_5' AS key_part").write.partitionBy("key_part").parquet(table)
    assert promotion.key_parts(spark, table, 99) == 5 and promotion.key_parts(spark, table) == 5


def test_cursor(spark, tmp_path):
    state = str(tmp_path / "state")
    assert incremental.read_cursor(spark, state, "t") == 0
    incremental.advance_cursor(spark, state, "t", 5)
    incremental.advance_cursor(spark, state, "t", 9)
    assert incremental.read_cursor(spark, state, "t") == 9
    table = spark.range(20)
    assert incremental.rows_after(table, "id", 9).count() == 10
    assert [r["id"] for r in incremental.rows_after(table, "id", 9, limit=3).collect()] == [10, 11, 12]


def land_and_promote(spark, base, lines_per_file, max_files):
    source = base / "in"
    source.mkdir(parents=True)
    for i, lines in enumerate(lines_per_file):
        (source / f"{i:03d}.json").write_text("\n".join(lines) + "\n")
        import os

        os.utime(source / f"{i:03d}.json", (1_700_000_000 + i, 1_700_000_000 + i))

    def run():
        stream = landing.landing_files(spark, str(source), max_files)
        landed = {}
        landing.drain(
            landing.land(
                stream, envelope.FLIGHT_PROVENANCE, str(base / "raw"), str(base / "bad"), str(base / "cp1"), landed
            )
        )
        landing.drain(
            promotion.promote(spark, str(base / "raw"), promotion.FLIGHTS, str(base / "silver"), str(base / "cp2"),
                              ["batch_id", "arrival"])
        )
        return landed

    return run


def silver_rows(spark, base):
    table = spark.read.parquet(str(base / "silver"))
    return sorted((r["flight_iata"], r["dep_delay_min"], r["dep_terminal"]) for r in table.collect())


def test_streams_are_incremental_and_keep_first_terminal(spark, tmp_path):
    when = "2026-04-10T08:00:00"
    batches = [
        [message(flight("kc1", when, 5, "A")), message(flight("kc2", when, 1, "A")), "{bad"],
        [message(flight("kc1", when, None, "B")), message(flight("kc3", "2026-04-11T08:00:00", 3, "C"))],
    ]
    run = land_and_promote(spark, tmp_path / "a", batches[:1], None)
    assert run() == {"consumed": 3, "failed": 1, "inserted": 2}
    assert silver_rows(spark, tmp_path / "a") == [("KC1", 5, "A"), ("KC2", 1, "A")]
    (tmp_path / "a" / "in" / "001.json").write_text("\n".join(batches[1]) + "\n")
    assert run() == {"consumed": 2, "failed": 0, "inserted": 2}
    assert silver_rows(spark, tmp_path / "a") == [("KC1", None, "A"), ("KC2", 1, "A"), ("KC3", 3, "C")]
    assert run() == {"consumed": 0, "failed": 0, "inserted": 0}
    assert spark.read.parquet(str(tmp_path / "a" / "bad")).count() == 1


def test_split_into_files_does_not_change_mutable_columns(spark, tmp_path):
    when = "2026-04-10T08:00:00"
    lines = [message(flight(f"kc{i % 3}", when, i, "A")) for i in range(9)]
    land_and_promote(spark, tmp_path / "one", [lines], None)()
    land_and_promote(spark, tmp_path / "many", [[line] for line in lines], 2)()
    assert silver_rows(spark, tmp_path / "one") == silver_rows(spark, tmp_path / "many") == [
        ("KC0", 6, "A"), ("KC1", 7, "A"), ("KC2", 8, "A"),
    ]


def test_grouping_of_landed_batches_changes_no_column(spark, tmp_path):
    when = "2026-04-10T08:00:00"
    batches = [[message(flight("kc1", when, n, t))] for n, t in enumerate("ABC")]
    run = land_and_promote(spark, tmp_path / "steps", batches[:1], 1)
    run()
    for number, lines in enumerate(batches[1:], 1):
        (tmp_path / "steps" / "in" / f"00{number}.json").write_text("\n".join(lines) + "\n")
        run()
    land_and_promote(spark, tmp_path / "together", batches, 1)()
    assert silver_rows(spark, tmp_path / "steps") == silver_rows(spark, tmp_path / "together") == [("KC1", 2, "A")]


def test_replay_equals_one_upsert_per_batch(spark, tmp_path):
    from slotwise.operators.upsert import rewrite_partitions

    data = [(k, b, b * 10 + i, f"f{b}") for b in range(3) for i, k in enumerate(["a", "b", "a"]) if (k, b) != ("b", 1)]
    df = spark.createDataFrame([(*row, n) for n, row in enumerate(data)], "k string, b int, v int, f string, n long")
    whole = replay(df, ["k"], ["v"], "b", ["n"])
    path = str(tmp_path / "t")
    for b in range(3):
        batch = silver.keep_last(df.where(F.col("b") == b), ["k"], ["n"]).drop("n", "b").withColumn("part", F.lit(0))
        rewrite_partitions(batch, path, ["k"], ["v"], "part")
    stepwise = spark.read.parquet(path)
    assert sorted(map(tuple, whole.select("k", "v", "f").collect())) == sorted(
        map(tuple, stepwise.select("k", "v", "f").collect())
    )


# ---------------------------------------------------------------------- gold
def flights_frame(spark, data):
    return spark.createDataFrame(
        data,
        "flight_iata string, dep_iata string, dep_icao string, arr_iata string, arr_icao string, "
        "dep_scheduled_utc timestamp, arr_scheduled_utc timestamp, dep_delay_min int, airline_iata string",
    ).selectExpr("*", "'landed' AS status", "'X' AS airline_icao", "'1' AS flight_number", "CAST(NULL AS STRING) AS dep_terminal")


def notams_frame(spark, data):
    return spark.createDataFrame(
        data, "notam_number string, location_icao string, start_utc timestamp, end_utc timestamp, condition_text string"
    )


def airports_frame(spark):
    return spark.createDataFrame(
        [("ALA", "large_airport", 43.0, 77.0, 2234, "KZ", "KZ-A", "Almaty", True),
         ("IST", "large_airport", 41.0, 28.0, 325, "TR", "TR-I", "Istanbul", True)],
        "iata_code string, type string, latitude_deg double, longitude_deg double, elevation_ft int, "
        "iso_country string, iso_region string, municipality string, scheduled_service boolean",
    )


T = datetime(2026, 4, 10, 12)


def build(spark, flights, notams, **options):
    return {
        r["flight_iata"]: r
        for r in gold.build_features(
            flights_frame(spark, flights), airports_frame(spark), notams_frame(spark, notams),
            datetime(2026, 4, 10), datetime(2026, 4, 11), gold.GoldOptions(**options),
        ).collect()
    }


def test_gold_horizon_mask_and_registry(spark):
    flights = [("F1", "ALA", "UAAA", "IST", "LTFM", T, datetime(2026, 4, 10, 18), 16, "KC"),
               ("F2", "GUW", "UATG", "ALA", "UAAA", T, datetime(2026, 4, 10, 12, 30), 15, None),
               ("F3", None, None, None, None, T, None, None, "KC")]
    h = lambda hour, minute=0: datetime(2026, 4, 10, hour, minute)
    notams = [("N1", "UAAA", h(10), h(12), "RWY CLSD"),          # both bounds touch
              ("N2", "UAAA", h(10, 1), h(20), "military"),       # a minute too late
              ("N3", "UAAA", h(1), h(11, 59), "military"),       # over before departure
              ("N4", "UAAA", h(1), None, "military"),            # no end
              ("N5", "UAAA", h(0), h(23), None),
              ("N6", "LTFM", h(0), h(23), "Restricted Area")]
    got = build(spark, flights, notams)
    f1, f2, f3 = got["F1"], got["F2"], got["F3"]
    assert set(f1.asDict()) == set(GOLD_REGISTRY)
    assert (f1["notam_count_dep"], f1["notam_active_dep"], f1["has_runway_closure_dep"]) == (2, 2, True)
    assert f1["has_military_exercise_dep"] is False and f1["notam_max_hours_dep"] == 23.0
    # Istanbul is not monitored: arrival side unknown, route values from the departure side.
    assert f1["notam_count_arr"] is None and f1["has_restriction_arr"] is None
    assert f1["notam_count_route"] == 2 and f1["has_airspace_restriction"] is False
    assert (f1["dep_notams_available"], f1["arr_notams_available"]) == (True, False)
    assert (f2["notam_count_dep"], f2["notam_count_arr"], f2["notam_count_route"]) == (0, 2, 2)
    assert f2["notam_max_hours_dep"] is None
    assert (f1["is_delayed"], f2["is_delayed"], f3["is_delayed"]) == (True, False, None)
    assert (f1["is_domestic"], f1["is_international"], f3["is_domestic"]) == (False, True, False)
    # F2 lands in Almaty in the hour in which F1 leaves it.
    assert (f1["flights_dep_same_hour"], f1["flights_arr_same_hour"]) == (1, 1)
    assert f3["flights_dep_same_hour"] == 1
    assert f1["hour_of_day"] == 12 and f1["day_of_week"] == 4 and f1["season"] == "spring"
    open_ended = build(spark, flights, notams, open_ended=True)
    assert open_ended["F1"]["notam_count_dep"] == 3


def test_gold_without_any_notice_still_masks(spark):
    got = build(spark, [("F1", "ALA", "UAAA", "IST", "LTFM", T, None, 1, "KC")], [])["F1"]
    assert got["notam_count_dep"] == 0 and got["notam_count_arr"] is None
    assert got["dep_notams_available"] is True and got["arr_notams_available"] is False


def test_gold_history_is_leakage_free(spark):
    def day(d, delay, name):
        return (name, "ALA", "UAAA", "IST", "LTFM", datetime(2026, 4, d, 12), None, delay, "KC")

    past = [day(3, 20, "P1"), day(9, 10, "P2"), day(2, 500, "P3"), day(11, 900, "L1")]
    one = build(spark, past + [day(10, 16, "F1"), day(10, 999, "F2")], [])
    two = build(spark, past + [day(10, 0, "F1"), day(10, 0, "F2")], [])
    for got in (one, two):
        assert got["F1"]["route_avg_delay_7d"] == 15.0 and got["F1"]["airline_delay_rate_7d"] == 0.5
        assert got["F1"]["dep_airport_avg_delay_30d"] == pytest.approx(530 / 3)
    assert set(one) == {"F1", "F2"}


def test_one_call_for_two_days_equals_two_calls(spark):
    import random

    random.seed(2)
    data = [
        (f"F{i}", random.choice(["ALA", "IST", None]), "UAAA", random.choice(["ALA", "IST", None]), "LTFM",
         datetime(2026, 4, random.randint(1, 11), random.randint(0, 23)), datetime(2026, 4, 10, random.randint(0, 23)),
         random.choice([None, 3, 30]), random.choice(["KC", "TK", None]))
        for i in range(120)
    ]
    flights, notams = flights_frame(spark, data), notams_frame(spark, [("N", "UAAA", datetime(2026, 4, 9), datetime(2026, 4, 11), "x")])

    def call(a, b):
        return gold.build_features(flights, airports_frame(spark), notams, datetime(2026, 4, a), datetime(2026, 4, b))

    both = {tuple(r) for r in call(10, 12).collect()}
    apart = {tuple(r) for r in call(10, 11).collect()} | {tuple(r) for r in call(11, 12).collect()}
    assert both == apart and both


def test_open_cells_with_one_hot_route(spark):
    """A third of all rows share one route, carrier and time."""
    data = [(f"H{i}", "ALA", "UAAA", "IST", "LTFM", T, None, 20, "KC") for i in range(60)]
    data += [(f"F{i}", "ALA", "UAAA", "IST", "LTFM", datetime(2026, 4, 10, i % 24, i % 60), None, 1, f"C{i}") for i in range(120)]
    got = build(spark, data, [("N", "UAAA", datetime(2026, 4, 9), datetime(2026, 4, 12), "military")])
    assert len(got) == 180
    assert {got[f"H{i}"]["flights_dep_same_hour"] for i in range(60)} == {65}
    assert all(r["notam_count_dep"] == 1 for r in got.values())


def test_partitioned_flights_are_pruned_by_day(spark, tmp_path):
    data = [(f"F{d}", "ALA", "UAAA", "IST", "LTFM", datetime(2026, 4, d, 12), None, d, "KC") for d in range(1, 12)]
    frame = flights_frame(spark, data)
    path = str(tmp_path / "silver")
    frame.withColumn("dep_date", F.to_date("dep_scheduled_utc")).write.partitionBy("dep_date").parquet(path)
    table = spark.read.parquet(path)
    plan = gold.departing(table, datetime(2026, 4, 10), datetime(2026, 4, 11))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dep_date" in plan

    def call(flights):
        return sorted(
            tuple(r) for r in gold.build_features(
                flights, airports_frame(spark), notams_frame(spark, []), datetime(2026, 4, 10), datetime(2026, 4, 11)
            ).collect()
        )

    assert call(table) == call(frame) and len(call(frame)) == 1
