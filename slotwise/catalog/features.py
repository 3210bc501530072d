"""Queries for casts, features, joins and the gold table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from slotwise.catalog.registry import Registry
from slotwise.catalog.views import (
    MONITORED, plain, silver_airports, silver_flights, silver_notams, table, view,
)
from slotwise.functions import casts, geo, rules, times
from slotwise.operators.attach import attach
from slotwise.operators.trailing import TOTALS, trailing_stats
from slotwise.plans import gold, history
from slotwise.schemas import GOLD_REGISTRY
from slotwise.session import new_work_dir

OPTIONS = gold.GoldOptions(monitored=tuple(MONITORED))

REGISTRY = Registry()
query = REGISTRY.query


# ------------------------------------------------------------------- scalars
@query("scalar_safe_casts", ["trips"], """
WITH raw AS (SELECT event_id,
    CASE k % 4 WHEN 0 THEN cast(k AS varchar) WHEN 1 THEN cast(k AS varchar) || '.0'
               WHEN 2 THEN 'x' || cast(k AS varchar) ELSE '' END AS num,
    CASE k % 3 WHEN 0 THEN strftime(dep_ts, '%Y-%m-%dT%H:%M:%S.%f')
               WHEN 1 THEN strftime(dep_ts, '%Y-%m-%dt%H:%M:%S.%f') ELSE 'bad' END AS tim,
    CASE WHEN k % 5 = 0 THEN '' ELSE carrier END AS code, dep_ts FROM trips)
SELECT event_id,
  CASE WHEN regexp_full_match(num, '[0-9]+') THEN cast(num AS bigint) END AS strict_int,
  CASE WHEN num = '' THEN NULL ELSE try_cast(num AS double) END AS number,
  CASE WHEN tim <> 'bad' THEN epoch_us(dep_ts) END AS at,
  upper(nullif(code, '')) AS code
FROM raw
""")
def scalar_safe_casts(spark, sf):
    raw = view(spark, sf, "trips").selectExpr(
        "event_id",
        "CASE k % 4 WHEN 0 THEN cast(k AS string) WHEN 1 THEN cast(k AS string) || '.0' "
        "WHEN 2 THEN 'x' || cast(k AS string) ELSE '' END AS num",
        "CASE k % 3 WHEN 0 THEN date_format(dep_ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") "
        "WHEN 1 THEN date_format(dep_ts, \"yyyy-MM-dd't'HH:mm:ss.SSSSSS\") ELSE 'bad' END AS tim",
        "CASE WHEN k % 5 = 0 THEN '' ELSE carrier END AS code",
    )
    return raw.select(
        "event_id",
        casts.strict_int(F.col("num")).alias("strict_int"),
        casts.number(F.col("num")).alias("number"),
        casts.utc_timestamp(F.col("tim")).alias("at"),
        casts.upper_code(F.col("code")).alias("code"),
    )


@query("scalar_time_features", ["trips"], """
SELECT event_id, cast(hour(dep_ts) AS bigint) AS hour_of_day,
  cast(isodow(dep_ts) - 1 AS bigint) AS day_of_week, cast(month(dep_ts) AS bigint) AS month,
  cast(day(dep_ts) AS bigint) AS day, cast(isodow(dep_ts) >= 6 AS bigint) AS is_weekend,
  epoch_us(date_trunc('hour', dep_ts)) AS hour_bucket,
  strftime(dep_ts, '%Y-%m-%d %H:%M:%S') || '+00:00' AS text
FROM trips
""")
def scalar_time_features(spark, sf):
    trips = view(spark, sf, "trips")
    base = gold.add_calendar(trips, "dep_ts")
    return base.select(
        "event_id", "hour_of_day", "day_of_week", "month",
        F.dayofmonth("dep_ts").alias("day"), "is_weekend",
        times.hour_bucket(F.col("dep_ts")).alias("hour_bucket"),
        times.utc_text(F.col("dep_ts")).alias("text"),
    )


@query("scalar_season", None, """
SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter'
  WHEN month(o_orderdate) IN (3, 4, 5) THEN 'spring'
  WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season
FROM orders
""")
def scalar_season(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", times.season(F.col("o_orderdate").cast("timestamp")).alias("season"))


@query("scalar_cyclic", ["trips"], """
SELECT event_id, round(sin(2 * pi() * hour(dep_ts) / 24), 6) + 0.0 AS dep_hour_sin,
  round(cos(2 * pi() * hour(dep_ts) / 24), 6) + 0.0 AS dep_hour_cos,
  round(sin(2 * pi() * (isodow(dep_ts) - 1) / 7), 6) + 0.0 AS dep_dow_sin,
  round(cos(2 * pi() * (isodow(dep_ts) - 1) / 7), 6) + 0.0 AS dep_dow_cos
FROM trips
""")
def scalar_cyclic(spark, sf):
    t = F.col("dep_ts")
    hs, hc = times.cyclic(F.hour(t), 24)
    ds, dc = times.cyclic(F.weekday(t), 7)
    return view(spark, sf, "trips").select(
        "event_id", hs.alias("dep_hour_sin"), hc.alias("dep_hour_cos"),
        ds.alias("dep_dow_sin"), dc.alias("dep_dow_cos"),
    )


@query("scalar_bool_normalise", ["trips"], """
WITH raw AS (SELECT event_id, CASE k % 8 WHEN 0 THEN ' Yes ' WHEN 1 THEN 'f' WHEN 2 THEN 'maybe'
  WHEN 3 THEN 'TRUE' WHEN 4 THEN '0' WHEN 5 THEN NULL WHEN 6 THEN 'n' ELSE '1' END AS w FROM trips)
SELECT event_id, cast(CASE WHEN lower(trim(w)) IN ('t','true','1','yes','y') THEN 1
  WHEN lower(trim(w)) IN ('f','false','0','no','n') THEN 0 END AS bigint) AS flag,
  cast(coalesce(lower(trim(w)) = 'yes', false) AS bigint) AS yes
FROM raw
""")
def scalar_bool_normalise(spark, sf):
    raw = view(spark, sf, "trips").selectExpr(
        "event_id",
        "CASE k % 8 WHEN 0 THEN ' Yes ' WHEN 1 THEN 'f' WHEN 2 THEN 'maybe' WHEN 3 THEN 'TRUE' "
        "WHEN 4 THEN '0' WHEN 5 THEN NULL WHEN 6 THEN 'n' ELSE '1' END AS w",
    )
    return raw.select(
        "event_id", casts.bool_word(F.col("w")).alias("flag"), casts.yes_flag(F.col("w")).alias("yes")
    )


@query("target_flag", ["trips"], """
SELECT event_id, cast(delay_min > 15 AS bigint) AS is_delayed,
  CASE WHEN delay_min IS NOT NULL THEN round(ln(1 + delay_min), 6) END AS log_minutes
FROM trips
""")
def target_flag(spark, sf):
    return view(spark, sf, "trips").select(
        "event_id", (F.col("delay_min") > 15).alias("is_delayed"),
        F.log1p("delay_min").alias("log_minutes"),
    )


HAVERSINE = """round(6371.0 * 2 * atan2(
  sqrt(pow(sin(radians({b}.latitude_deg - {a}.latitude_deg) / 2), 2) + cos(radians({a}.latitude_deg))
    * cos(radians({b}.latitude_deg)) * pow(sin(radians({b}.longitude_deg - {a}.longitude_deg) / 2), 2)),
  sqrt(1 - (pow(sin(radians({b}.latitude_deg - {a}.latitude_deg) / 2), 2) + cos(radians({a}.latitude_deg))
    * cos(radians({b}.latitude_deg)) * pow(sin(radians({b}.longitude_deg - {a}.longitude_deg) / 2), 2)))), 2)"""


@query("haversine_route", ["flights", "airports"], f"""
SELECT f.event_id, {HAVERSINE.format(a='d', b='a')} AS route_distance_km
FROM flights f LEFT JOIN airports d ON d.iata_code = f.dep_iata
LEFT JOIN airports a ON a.iata_code = f.arr_iata
""")
def haversine_route(spark, sf):
    rich = gold.enrich_airports(silver_flights(spark, sf), silver_airports(spark, sf))
    return gold.add_route(rich).select("event_id", "route_distance_km")


@query("domestic_flag", ["flights", "airports"], """
SELECT f.event_id, cast(coalesce(d.iso_country = a.iso_country, false) AS bigint) AS is_domestic,
  cast(NOT coalesce(d.iso_country = a.iso_country, false) AS bigint) AS is_international,
  coalesce(f.dep_iata, 'UNKNOWN') || '_' || coalesce(f.arr_iata, 'UNKNOWN') AS route
FROM flights f LEFT JOIN airports d ON d.iata_code = f.dep_iata
LEFT JOIN airports a ON a.iata_code = f.arr_iata
""")
def domestic_flag(spark, sf):
    rich = gold.enrich_airports(silver_flights(spark, sf), silver_airports(spark, sf))
    return gold.add_route(rich).select(
        "event_id", "is_domestic", "is_international",
        geo.route_label(F.col("dep_iata"), F.col("arr_iata")).alias("route"),
    )


@query("enrich_airports_left", ["flights", "airports"], """
SELECT f.event_id, d.type AS dep_airport_type, d.elevation_ft::bigint AS dep_elevation_ft,
  d.iso_region AS dep_iso_region, a.municipality AS arr_municipality,
  cast(a.scheduled_service AS bigint) AS arr_scheduled_service
FROM flights f LEFT JOIN airports d ON d.iata_code = f.dep_iata
LEFT JOIN airports a ON a.iata_code = f.arr_iata
""")
def enrich_airports_left(spark, sf):
    rich = gold.enrich_airports(silver_flights(spark, sf), silver_airports(spark, sf))
    return rich.select(
        "event_id", "dep_airport_type", "dep_elevation_ft", "dep_iso_region",
        "arr_municipality", "arr_scheduled_service",
    )


# ------------------------------------------------------------ trailing, hours
def _trailing(spark, sf, keys, prefix, null_keys):
    trips = view(spark, sf, "trips")
    stats = trailing_stats(trips, keys, "dep_ts", "delay_min", prefix, keep_null_keys=null_keys)
    days = trips.select("event_id", *keys, times.day_number(F.col("dep_ts")).alias("day_no"))
    out = attach(days, stats, [*keys, "day_no"], "n", ["event_id"], null_safe=null_keys)
    return out.drop(*keys, "day_no")


def _trailing_sql(on, prefix):
    """Correlated form: history strictly before the own day, 7 and 30 days back."""
    def stat(days):
        return f"""(SELECT t.event_id, avg(h.delay_min) AS m, avg(CASE WHEN h.delay_min > 15 THEN 1.0
          WHEN h.delay_min IS NOT NULL THEN 0.0 END) AS r
          FROM trips t LEFT JOIN trips h ON {on} AND h.delay_min IS NOT NULL
            AND h.dep_ts < date_trunc('day', t.dep_ts)
            AND h.dep_ts >= date_trunc('day', t.dep_ts) - INTERVAL {days} DAY
          GROUP BY t.event_id)"""
    return f"""SELECT w.event_id, round(w.m, 6) AS {prefix}_avg_delay_7d,
      round(w.r, 6) AS {prefix}_delay_rate_7d, round(x.m, 6) AS {prefix}_avg_delay_30d,
      round(x.r, 6) AS {prefix}_delay_rate_30d
      FROM {stat(7)} w JOIN {stat(30)} x ON w.event_id = x.event_id"""


@query("trailing_route_stats", ["trips"], _trailing_sql(
    "h.dep IS NOT DISTINCT FROM t.dep AND h.arr IS NOT DISTINCT FROM t.arr", "route"))
def trailing_route_stats(spark, sf):
    return _trailing(spark, sf, ["dep", "arr"], "route", True)


@query("trailing_carrier_stats", ["trips"], _trailing_sql("h.carrier = t.carrier", "airline"))
def trailing_carrier_stats(spark, sf):
    return _trailing(spark, sf, ["carrier"], "airline", False)


@query("trailing_airport_stats", ["trips"], _trailing_sql("h.dep = t.dep", "dep_airport"))
def trailing_airport_stats(spark, sf):
    return _trailing(spark, sf, ["dep"], "dep_airport", False)


def _congestion(spark, sf):
    flights = silver_flights(spark, sf)
    hours = gold.airport_hours(flights).withColumnRenamed("iata", "dep_iata")
    hours = hours.withColumn("_w", F.col("flights_dep_same_hour"))
    keyed = flights.select("event_id", "dep_iata", times.hour_bucket(F.col("dep_scheduled_utc")).alias("hour"))
    return attach(keyed, hours, ["dep_iata", "hour"], "_w", ["event_id"], null_safe=True)


@query("congestion_dep", ["flights"], """
WITH c AS (SELECT dep_iata, date_trunc('hour', dep_scheduled_utc) AS h, count(*) AS n FROM flights GROUP BY 1, 2)
SELECT f.event_id, cast(coalesce(c.n, 0) AS bigint) AS flights_dep_same_hour FROM flights f
LEFT JOIN c ON c.dep_iata IS NOT DISTINCT FROM f.dep_iata AND c.h = date_trunc('hour', f.dep_scheduled_utc)
""")
def congestion_dep(spark, sf):
    return _congestion(spark, sf).select(
        "event_id", F.coalesce("flights_dep_same_hour", F.lit(0)).alias("flights_dep_same_hour")
    )


@query("congestion_arr_at_dep", ["flights"], """
WITH c AS (SELECT arr_iata, date_trunc('hour', arr_scheduled_utc) AS h, count(*) AS n FROM flights GROUP BY 1, 2)
SELECT f.event_id, cast(coalesce(c.n, 0) AS bigint) AS flights_arr_same_hour FROM flights f
LEFT JOIN c ON c.arr_iata IS NOT DISTINCT FROM f.dep_iata AND c.h = date_trunc('hour', f.dep_scheduled_utc)
""")
def congestion_arr_at_dep(spark, sf):
    return _congestion(spark, sf).select(
        "event_id", F.coalesce("flights_arr_same_hour", F.lit(0)).alias("flights_arr_same_hour")
    )


@query("null_safe_route_join", ["trips"], """
WITH r AS (SELECT dep, arr, count(*) AS n, count(delay_min) AS labelled FROM trips GROUP BY dep, arr)
SELECT t.event_id, cast(r.labelled AS bigint) AS labelled FROM trips t
LEFT JOIN r ON r.dep IS NOT DISTINCT FROM t.dep AND r.arr IS NOT DISTINCT FROM t.arr
""")
def null_safe_route_join(spark, sf):
    trips = view(spark, sf, "trips")
    routes = trips.groupBy("dep", "arr").agg(
        F.count(F.lit(1)).alias("n"), F.count("delay_min").alias("labelled")
    )
    keyed = trips.select("event_id", "dep", "arr")
    return attach(keyed, routes, ["dep", "arr"], "n", ["event_id"], null_safe=True).select(
        "event_id", "labelled"
    )


# ------------------------------------------------------------------- notices
NOTICE_AGG = """count(n.notice_no) AS notices, count(CASE WHEN n.txt ILIKE '%restricted area%' THEN 1 END) AS restriction,
  count(CASE WHEN n.txt ILIKE '%parachute%' THEN 1 END) AS parachute,
  count(CASE WHEN n.txt ILIKE '%military%' THEN 1 END) AS military,
  count(CASE WHEN n.txt ILIKE '%rwy clsd%' OR n.txt ILIKE '%runway closed%' THEN 1 END) AS runway_closed,
  max(greatest(0, (epoch_us(n.en) - epoch_us(n.st)) / 3600000000.0::double)) AS max_hours"""
ACTIVE = "n.st <= f.dep_scheduled_utc - INTERVAL 2 HOUR AND n.en >= f.dep_scheduled_utc"


@query("notam_interval_join", ["flights", "notices"], f"""
SELECT n.loc AS icao, epoch_us(f.dep_scheduled_utc) AS at, cast(count(*) AS bigint) AS notices,
  round(max((epoch_us(n.en) - epoch_us(n.st)) / 3600000000.0::double), 6) AS max_hours
FROM (SELECT DISTINCT icao, dep_scheduled_utc FROM (SELECT dep_icao AS icao, dep_scheduled_utc FROM flights
  UNION ALL SELECT arr_icao, dep_scheduled_utc FROM flights) q WHERE icao IS NOT NULL) f
JOIN notices n ON n.loc = f.icao AND {ACTIVE} GROUP BY 1, 2
""")
def notam_interval_join(spark, sf):
    points = gold.notice_points(silver_flights(spark, sf))
    features = gold.notice_features(points, silver_notams(spark, sf), OPTIONS)
    return features.select("icao", "at", "notices", "max_hours")


@query("notam_flags_agg", ["flights", "notices"], f"""
SELECT f.event_id, cast(notices AS bigint) AS notam_count_dep, cast(notices AS bigint) AS notam_active_dep,
  round(max_hours, 6) AS notam_max_hours_dep, cast(restriction > 0 AS bigint) AS has_restriction_dep,
  cast(runway_closed > 0 AS bigint) AS has_runway_closure_dep,
  cast(parachute > 0 AS bigint) AS has_parachute_activity_dep,
  cast(military > 0 AS bigint) AS has_military_exercise_dep
FROM flights f LEFT JOIN (SELECT f.event_id, {NOTICE_AGG} FROM flights f
  JOIN notices n ON n.loc = f.dep_icao AND {ACTIVE} GROUP BY f.event_id) x ON x.event_id = f.event_id
""")
def notam_flags_agg(spark, sf):
    flights = silver_flights(spark, sf)
    keyed = flights.select("event_id", "dep_icao", "dep_scheduled_utc")
    out = gold.add_notices(
        keyed, flights, silver_notams(spark, sf), OPTIONS, ["event_id"], sides=("dep",)
    )
    return out.drop("dep_icao", "dep_scheduled_utc")


NOTICE_SIDES = f"""
side_dep AS (SELECT f.event_id, {NOTICE_AGG} FROM flights f
  JOIN notices n ON n.loc = f.dep_icao AND {ACTIVE} GROUP BY f.event_id),
side_arr AS (SELECT f.event_id, {NOTICE_AGG} FROM flights f
  JOIN notices n ON n.loc = f.arr_icao AND {ACTIVE} GROUP BY f.event_id),
masked AS (SELECT f.*, coalesce(f.arr_iata IN ('A0','A1','A2','A3','A4'), false) AS cov,
  coalesce(d.notices, 0) AS nd, coalesce(a.notices, 0) AS na,
  coalesce(d.restriction > 0, false) AS rd, coalesce(a.restriction > 0, false) AS ra,
  coalesce(d.parachute > 0, false) AS pd, coalesce(d.military > 0, false) AS md,
  coalesce(d.runway_closed > 0, false) AS cd, coalesce(a.runway_closed > 0, false) AS ca,
  d.max_hours AS hd, a.max_hours AS ha
  FROM flights f LEFT JOIN side_dep d ON d.event_id = f.event_id
  LEFT JOIN side_arr a ON a.event_id = f.event_id)"""
NOTICE_COLUMNS = """cast(nd AS bigint) AS notam_count_dep,
  cast(CASE WHEN cov THEN na END AS bigint) AS notam_count_arr,
  cast(CASE WHEN cov THEN nd + na ELSE nd END AS bigint) AS notam_count_route,
  cast(nd AS bigint) AS notam_active_dep, cast(CASE WHEN cov THEN na END AS bigint) AS notam_active_arr,
  cast(rd AS bigint) AS has_restriction_dep, cast(CASE WHEN cov THEN ra END AS bigint) AS has_restriction_arr,
  cast(pd AS bigint) AS has_parachute_activity_dep, cast(md AS bigint) AS has_military_exercise_dep,
  cast(cd AS bigint) AS has_runway_closure_dep, cast(CASE WHEN cov THEN ca END AS bigint) AS has_runway_closure_arr,
  cast(CASE WHEN cov THEN rd OR ra ELSE rd END AS bigint) AS has_airspace_restriction,
  round(hd, 6) AS notam_max_hours_dep, round(CASE WHEN cov THEN ha END, 6) AS notam_max_hours_arr,
  cast(coalesce(dep_iata IN ('A0','A1','A2','A3','A4'), false) AS bigint) AS dep_notams_available,
  cast(cov AS bigint) AS arr_notams_available"""
NOTICE_NAMES = [
    "notam_count_dep", "notam_count_arr", "notam_count_route", "notam_active_dep", "notam_active_arr",
    "has_restriction_dep", "has_restriction_arr", "has_parachute_activity_dep",
    "has_military_exercise_dep", "has_runway_closure_dep", "has_runway_closure_arr",
    "has_airspace_restriction", "notam_max_hours_dep", "notam_max_hours_arr",
    "dep_notams_available", "arr_notams_available",
]


@query("notam_coverage_mask", ["flights", "notices"],
       f"WITH {NOTICE_SIDES} SELECT event_id, {NOTICE_COLUMNS} FROM masked")
def notam_coverage_mask(spark, sf):
    flights = silver_flights(spark, sf)
    keyed = flights.select("event_id", "dep_iata", "arr_iata", "dep_icao", "arr_icao", "dep_scheduled_utc")
    out = gold.add_notices(keyed, flights, silver_notams(spark, sf), OPTIONS, ["event_id"])
    return gold.notice_columns(out, OPTIONS).select("event_id", *NOTICE_NAMES)


@query("text_flags", None, """
SELECT doc_id, cast(lower(coalesce(text, '')) LIKE '%restricted area%' AS bigint) AS restriction,
  cast(lower(coalesce(text, '')) LIKE '%parachute%' AS bigint) AS parachute,
  cast(lower(coalesce(text, '')) LIKE '%military%' AS bigint) AS military,
  cast(regexp_matches(lower(coalesce(text, '')), 'rwy clsd|runway closed') AS bigint) AS runway_closed
FROM documents
""")
def text_flags(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id", *[rules.text_flag(F.col("text"), p).alias(n) for n, p in rules.TEXT_FLAGS.items()]
    )


# ---------------------------------------------------------------------- gold
def departure_range(flights):
    """[start, end) of all departures of the table."""
    first, last = flights.agg(F.min("dep_scheduled_utc"), F.max("dep_scheduled_utc")).first()
    start = first or datetime(1970, 1, 1)
    return start, (last or start) + timedelta(microseconds=1)


def gold_table(spark, sf):
    """Features of all departures."""
    flights = silver_flights(spark, sf)
    start, end = departure_range(flights)
    return gold.build_features(flights, silver_airports(spark, sf), silver_notams(spark, sf), start, end, OPTIONS)


def _hist(on, days):
    return f"""(SELECT t.event_id, avg(h.dep_delay_min) AS m, avg(CASE WHEN h.dep_delay_min > 15 THEN 1.0 ELSE 0.0 END) AS r
      FROM flights t JOIN flights h ON {on} AND h.dep_delay_min IS NOT NULL
        AND h.dep_scheduled_utc < date_trunc('day', t.dep_scheduled_utc)
        AND h.dep_scheduled_utc >= date_trunc('day', t.dep_scheduled_utc) - INTERVAL {days} DAY
      GROUP BY t.event_id)"""


_ROUTE = "h.dep_iata IS NOT DISTINCT FROM t.dep_iata AND h.arr_iata IS NOT DISTINCT FROM t.arr_iata"
_AIRLINE = "h.airline_iata = t.airline_iata"
_AIRPORT = "h.dep_iata = t.dep_iata"
GOLD_SQL = f"""WITH {NOTICE_SIDES},
cdep AS (SELECT dep_iata, date_trunc('hour', dep_scheduled_utc) AS h, count(*) AS n FROM flights GROUP BY 1, 2),
carr AS (SELECT arr_iata, date_trunc('hour', arr_scheduled_utc) AS h, count(*) AS n FROM flights
  WHERE arr_scheduled_utc IS NOT NULL GROUP BY 1, 2),
gold AS (
SELECT m.flight_iata, epoch_us(m.dep_scheduled_utc) AS dep_scheduled_utc, m.dep_iata, m.arr_iata,
  m.airline_iata, m.airline_icao, m.status, m.dep_terminal, m.flight_number,
  cast(m.dep_delay_min AS bigint) AS dep_delay_min, cast(m.dep_delay_min > 15 AS bigint) AS is_delayed,
  cast(hour(m.dep_scheduled_utc) AS bigint) AS hour_of_day,
  cast(isodow(m.dep_scheduled_utc) - 1 AS bigint) AS day_of_week,
  cast(month(m.dep_scheduled_utc) AS bigint) AS month,
  CASE WHEN month(m.dep_scheduled_utc) IN (12, 1, 2) THEN 'winter' WHEN month(m.dep_scheduled_utc) IN (3, 4, 5) THEN 'spring'
    WHEN month(m.dep_scheduled_utc) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season,
  cast(isodow(m.dep_scheduled_utc) >= 6 AS bigint) AS is_weekend,
  d.type AS dep_airport_type, d.latitude_deg AS dep_latitude, d.longitude_deg AS dep_longitude,
  cast(d.elevation_ft AS bigint) AS dep_elevation_ft, d.iso_country AS dep_iso_country, d.iso_region AS dep_iso_region,
  d.municipality AS dep_municipality, cast(d.scheduled_service AS bigint) AS dep_scheduled_service,
  a.type AS arr_airport_type, a.latitude_deg AS arr_latitude, a.longitude_deg AS arr_longitude,
  cast(a.elevation_ft AS bigint) AS arr_elevation_ft, a.iso_country AS arr_iso_country, a.iso_region AS arr_iso_region,
  a.municipality AS arr_municipality, cast(a.scheduled_service AS bigint) AS arr_scheduled_service,
  {HAVERSINE.format(a='d', b='a')} AS route_distance_km,
  cast(coalesce(d.iso_country = a.iso_country, false) AS bigint) AS is_domestic,
  cast(NOT coalesce(d.iso_country = a.iso_country, false) AS bigint) AS is_international,
  round(r7.m, 6) AS route_avg_delay_7d, round(r30.m, 6) AS route_avg_delay_30d, round(r7.r, 6) AS route_delay_rate_7d,
  round(l7.m, 6) AS airline_avg_delay_7d, round(l30.m, 6) AS airline_avg_delay_30d, round(l7.r, 6) AS airline_delay_rate_7d,
  round(p7.m, 6) AS dep_airport_avg_delay_7d, round(p30.m, 6) AS dep_airport_avg_delay_30d,
  round(p7.r, 6) AS dep_airport_delay_rate_7d,
  {NOTICE_COLUMNS.replace('dep_iata IN', 'm.dep_iata IN')},
  cast(coalesce(cdep.n, 0) AS bigint) AS flights_dep_same_hour,
  cast(coalesce(carr.n, 0) AS bigint) AS flights_arr_same_hour
FROM masked m
LEFT JOIN airports d ON d.iata_code = m.dep_iata LEFT JOIN airports a ON a.iata_code = m.arr_iata
LEFT JOIN {_hist(_ROUTE, 7)} r7 ON r7.event_id = m.event_id
LEFT JOIN {_hist(_ROUTE, 30)} r30 ON r30.event_id = m.event_id
LEFT JOIN {_hist(_AIRLINE, 7)} l7 ON l7.event_id = m.event_id
LEFT JOIN {_hist(_AIRLINE, 30)} l30 ON l30.event_id = m.event_id
LEFT JOIN {_hist(_AIRPORT, 7)} p7 ON p7.event_id = m.event_id
LEFT JOIN {_hist(_AIRPORT, 30)} p30 ON p30.event_id = m.event_id
LEFT JOIN cdep ON cdep.dep_iata IS NOT DISTINCT FROM m.dep_iata AND cdep.h = date_trunc('hour', m.dep_scheduled_utc)
LEFT JOIN carr ON carr.arr_iata IS NOT DISTINCT FROM m.dep_iata AND carr.h = date_trunc('hour', m.dep_scheduled_utc))
"""


@query("gold_features", ["flights", "notices", "airports"], GOLD_SQL + "SELECT * FROM gold")
def gold_features(spark, sf):
    return gold_table(spark, sf)


@query("gold_rebuild_window", ["flights", "notices", "airports"],
       GOLD_SQL + """SELECT cast(make_timestamp(dep_scheduled_utc)::date AS varchar) AS dep_date,
  count(*) AS flights, cast(sum(dep_delay_min) AS bigint) AS minutes,
  cast(sum(notam_count_route) AS bigint) AS notices, cast(sum(flights_dep_same_hour) AS bigint) AS same_hour
FROM gold GROUP BY 1""")
def gold_rebuild_window(spark, sf):
    """Write all days, then rebuild the last week as a later run would."""
    path = new_work_dir(spark, "gold")
    gold.write_features(gold_table(spark, sf), path)
    flights = silver_flights(spark, sf)
    _, end = departure_range(flights)
    again = gold.build_features(
        flights, silver_airports(spark, sf), silver_notams(spark, sf),
        datetime.combine(end.date() - timedelta(days=7), datetime.min.time()), end, OPTIONS,
    )
    gold.write_features(again, path)
    return spark.read.parquet(path).groupBy("dep_date").agg(
        F.count(F.lit(1)).alias("flights"), F.sum("dep_delay_min").alias("minutes"),
        F.sum("notam_count_route").alias("notices"), F.sum("flights_dep_same_hour").alias("same_hour"),
    )


@query("gold_maintained", ["flights", "notices", "airports"], GOLD_SQL + "SELECT * FROM gold")
def gold_maintained(spark, sf):
    """All flights come with a third of the last ten days' delays wrong; gold is built from the
    kept sums, the corrections follow as a second batch, and the days they reach are rebuilt."""
    base = new_work_dir(spark, "history")
    flights = silver_flights(spark, sf)
    _, end = departure_range(flights)
    wrong = (F.col("dep_scheduled_utc") >= F.lit(end - timedelta(days=10))) & (F.col("event_id") % 3 == 0)
    kept = history.FlightHistory(spark, base)
    kept.apply(1, flights.withColumn("dep_delay_min", F.when(wrong, 500).otherwise(F.col("dep_delay_min"))))
    airports, notices = silver_airports(spark, sf), silver_notams(spark, sf)
    kept.rebuild(f"{base}/gold", airports, notices, None, OPTIONS)
    kept.apply(2, flights.where(wrong))
    kept.rebuild(f"{base}/gold", airports, notices, 1, OPTIONS)
    return spark.read.parquet(f"{base}/gold").select(*GOLD_REGISTRY)


@query("history_sums", ["flights"], """
SELECT dep_iata, arr_iata, airline_iata, cast(dep_scheduled_utc::date - DATE '1970-01-01' AS bigint) AS day_no, count(*) AS n,
  count(dep_delay_min) AS labelled, cast(coalesce(sum(dep_delay_min), 0) AS bigint) AS minutes,
  count(CASE WHEN dep_delay_min > 15 THEN 1 END) AS late FROM flights GROUP BY 1, 2, 3, 4
""")
def history_sums(spark, sf):
    """Three batches, the second of them twice: first delays, corrected ones, the rest of the flights;
    the first two are folded."""
    flights, early = silver_flights(spark, sf), F.col("event_id") % 4 != 0
    kept = history.FlightHistory(spark, new_work_dir(spark, "history"))
    kept.apply(1, flights.where(early).withColumn("dep_delay_min", F.col("dep_delay_min") + 7))
    for _ in range(2):
        kept.apply(2, flights.where(early))
    kept.days.fold(2)
    kept.apply(3, flights.where(~early))
    return kept.days.totals().select(*kept.days.keys, *TOTALS)


def flagship(spark, sf):
    """Trailing route statistics, same-hour congestion and target per trip."""
    route = _trailing(spark, sf, ["dep", "arr"], "route", True)
    target = target_flag(spark, sf).select("event_id", "is_delayed")
    return plain(route.join(_congestion(spark, sf).drop("dep_iata", "hour"), "event_id").join(target, "event_id"))
