"""Role views: the given tables dressed as trips, notices and airports.

Each view is one SQL text that Spark and DuckDB both run; where an interval needs
engine-specific syntax the text has a slot for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from slotwise.session import configure

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Codes 25..27 have no airport; some routes, carriers, delays and terminals are NULL.
TRIPS = """
SELECT event_id, cast(ts AS timestamp) AS dep_ts, cast(user_id % 28 AS int) AS dep,
  CASE WHEN k % 10 = 9 THEN NULL ELSE cast(event_id % 28 AS int) END AS arr,
  CASE WHEN k % 13 = 0 THEN NULL ELSE event_type END AS carrier,
  CASE WHEN k % 7 = 0 THEN NULL ELSE cast(floor(value) AS int) END AS delay_min,
  CASE WHEN k % 20 = 0 THEN 'cancelled' WHEN k % 20 = 1 THEN ' Diverted '
       WHEN k % 20 = 2 THEN NULL ELSE 'landed' END AS status,
  CASE WHEN k % 3 = 0 THEN NULL ELSE 'A' END AS terminal,
  k, value, event_type
FROM (SELECT *, cast(regexp_extract(props, '[0-9]+', 0) AS int) AS k FROM events) e
"""

FLIGHTS = """
SELECT event_id, 'FL' || cast(event_id AS string) AS flight_iata,
  'N' || cast(k AS string) AS flight_number,
  upper(carrier) AS airline_iata, upper(carrier) || 'X' AS airline_icao,
  status, terminal AS dep_terminal,
  'A' || cast(dep AS string) AS dep_iata, 'X' || cast(dep AS string) AS dep_icao,
  dep_ts AS dep_scheduled_utc, delay_min AS dep_delay_min,
  'A' || cast(arr AS string) AS arr_iata, 'X' || cast(arr AS string) AS arr_icao,
  CASE WHEN arr IS NOT NULL THEN dep_ts + <minutes> END AS arr_scheduled_utc
FROM trips
"""

NOTICES = """
SELECT event_id AS notice_no, 'X' || cast(user_id % 28 AS string) AS loc,
  cast(ts AS timestamp) AS st,
  CASE WHEN k % 17 = 0 THEN NULL ELSE cast(ts AS timestamp) + <hours> END AS en,
  CASE k % 5 WHEN 0 THEN 'RWY CLSD due works' WHEN 1 THEN 'Military exercise'
    WHEN 2 THEN 'PARACHUTE jumping' WHEN 4 THEN 'restricted area active' END AS txt
FROM (SELECT *, cast(regexp_extract(props, '[0-9]+', 0) AS int) AS k FROM events
      WHERE event_type = 'error') e
"""

AIRPORTS = """
SELECT 'A' || cast(n_nationkey AS string) AS iata_code,
  'X' || cast(n_nationkey AS string) AS icao_code,
  CASE WHEN n_nationkey % 3 = 0 THEN 'large_airport' ELSE 'medium_airport' END AS type,
  -60.0E0 + 5 * n_nationkey AS latitude_deg, -150.0E0 + 12 * n_nationkey AS longitude_deg,
  CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE cast(100 * n_nationkey AS int) END AS elevation_ft,
  r_name AS iso_country, r_name || '-' || cast(n_nationkey % 4 AS string) AS iso_region,
  n_name AS municipality, n_nationkey % 2 = 0 AS scheduled_service
FROM nation JOIN region ON n_regionkey = r_regionkey
"""

# Scores with many ties, so that ties matter; y and the minutes are real.
SCORED = """
SELECT event_id, dep_ts, dep, arr, carrier, k,
  cast((event_id * 7919) % 1000 AS double) / 1000.0E0 AS p,
  CASE WHEN delay_min > 15 THEN 1 ELSE 0 END AS y,
  cast(delay_min AS double) AS minutes, cast((event_id * 31) % 120 AS double) AS pred_min
FROM trips WHERE delay_min IS NOT NULL
"""

_SLOTS = {
    "spark": {
        "<minutes>": "make_interval(0, 0, 0, 0, 0, 30 + k, 0)",
        "<hours>": "make_interval(0, 0, 0, 0, cast(floor(value) AS int), 0, 0)",
    },
    "duckdb": {
        "<minutes>": "to_minutes(cast(30 + k AS bigint))",
        "<hours>": "to_hours(cast(floor(value) AS bigint))",
    },
}
_VIEWS = {
    "trips": TRIPS, "flights": FLIGHTS, "notices": NOTICES, "airports": AIRPORTS, "scored": SCORED,
}
_NEEDS = {"flights": ["trips"], "scored": ["trips"]}

MONITORED = ["A0", "A1", "A2", "A3", "A4"]


def _fill(text: str, engine: str) -> str:
    for slot, code in _SLOTS[engine].items():
        text = text.replace(slot, code)
    return text


def oracle(names: list[str], query: str) -> str:
    """DuckDB text of a query with the views it needs as common table expressions."""
    ordered = []
    for name in names:
        for needed in [*_NEEDS.get(name, []), name]:
            if needed not in ordered:
                ordered.append(needed)
    views = ", ".join(f"{n} AS ({_fill(_VIEWS[n], 'duckdb')})" for n in ordered)
    query = query.strip()
    if query.upper().startswith("WITH "):
        return f"WITH {views}, {query[5:]}"
    return f"WITH {views} {query}"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    text = _fill(_VIEWS[name], "spark")
    if name in _NEEDS:
        return spark.sql(text.replace("FROM trips", "FROM {trips}"), trips=view(spark, sf, "trips"))
    if name == "airports":
        text = text.replace("FROM nation JOIN region", "FROM {nation} JOIN {region}")
        return spark.sql(
            text, nation=table(spark, sf, "nation"), region=table(spark, sf, "region")
        )
    return spark.sql(text.replace("FROM events", "FROM {events}"), events=table(spark, sf, "events"))


def silver_flights(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "flights")


def silver_notams(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "notices").select(
        F.col("notice_no").cast("string").alias("notam_number"),
        F.col("loc").alias("location_icao"),
        F.col("st").alias("start_utc"),
        F.col("en").alias("end_utc"),
        F.col("txt").alias("condition_text"),
    )


def silver_airports(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "airports")


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Result in types both engines spell alike: whole numbers and booleans as
    bigint, times as microseconds, dates as text, doubles rounded."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("tinyint", "smallint", "int", "bigint", "boolean"):
            c = c.cast("bigint")
        elif kind == "timestamp":
            c = F.unix_micros(c)
        elif kind == "timestamp_ntz":
            c = F.unix_micros(c.cast("timestamp"))
        elif kind == "date":
            c = c.cast("string")
        elif kind in ("float", "double") or kind.startswith("decimal"):
            # Adding zero turns a negative zero into zero.
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        out.append(c.alias(name))
    return df.select(*out)
