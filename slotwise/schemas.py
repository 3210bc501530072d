"""Table schemas and the gold column registry."""

from __future__ import annotations

from pyspark.sql import types as T

S, TS, D, I, L, DBL, B, SH = (
    T.StringType(), T.TimestampType(), T.DateType(), T.IntegerType(),
    T.LongType(), T.DoubleType(), T.BooleanType(), T.ShortType(),
)


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# ---------------------------------------------------------------- raw input
# Payload paths of the two feeds. Delays may come as JSON numbers or strings,
# hence VARIANT.
FLIGHT_PAYLOAD = _struct(
    status=S,
    flight=_struct(iataNumber=S, icaoNumber=S, number=S),
    airline=_struct(name=S, iataCode=S, icaoCode=S),
    departure=_struct(
        iataCode=S, icaoCode=S, terminal=S, scheduledTime=S, estimatedTime=S,
        actualTime=S, estimatedRunway=S, actualRunway=S, delay=T.VariantType(),
    ),
    arrival=_struct(
        iataCode=S, icaoCode=S, baggage=S, scheduledTime=S, estimatedTime=S,
        actualTime=S, delay=T.VariantType(),
    ),
)
NOTAM_PAYLOAD = _struct(
    **{"number": S, "location": S, "class": S, "startdateutc": S, "enddateutc": S, "condition": S}
)

# Columns of the airport snapshot, in file order (fixed values).
AIRPORT_CSV_COLUMNS = [
    "id", "ident", "type", "name", "latitude_deg", "longitude_deg", "elevation_ft",
    "continent", "iso_country", "iso_region", "municipality", "scheduled_service",
    "icao_code", "iata_code", "gps_code", "local_code", "home_link", "wikipedia_link",
    "keywords",
]
AIRPORT_TYPES = ["large_airport", "medium_airport", "small_airport"]

# ------------------------------------------------------------------- silver
SILVER_FLIGHTS = _struct(
    flight_iata=S, flight_icao=S, flight_number=S,
    airline_name=S, airline_iata=S, airline_icao=S, status=S,
    dep_iata=S, dep_icao=S, dep_terminal=S,
    dep_scheduled_utc=TS, dep_estimated_utc=TS, dep_actual_utc=TS,
    dep_estimated_runway_utc=TS, dep_actual_runway_utc=TS, dep_delay_min=I,
    arr_iata=S, arr_icao=S, arr_baggage=S,
    arr_scheduled_utc=TS, arr_estimated_utc=TS, arr_actual_utc=TS, arr_delay_min=I,
    queried_airport=S, chunk_from=D, chunk_to=D, source=S, ingestion_ts_utc=TS,
)
SILVER_NOTAMS = _struct(
    **{
        "notam_number": S, "location_icao": S, "class": S, "start_utc": TS, "end_utc": TS,
        "condition_text": S, "queried_airport": S, "source": S, "ingestion_ts_utc": TS,
    }
)
SILVER_AIRPORTS = _struct(
    iata_code=S, icao_code=S, ident=S, name=S, type=S,
    latitude_deg=DBL, longitude_deg=DBL, elevation_ft=I,
    continent=S, iso_country=S, iso_region=S, municipality=S, scheduled_service=B,
)

# Upsert contracts: key, and the columns a re-delivery overwrites. Every other
# column keeps its first value (fixed values).
FLIGHT_KEY = ["flight_iata", "dep_scheduled_utc"]
FLIGHT_MUTABLE = [
    "status", "dep_estimated_utc", "dep_actual_utc", "dep_estimated_runway_utc",
    "dep_actual_runway_utc", "dep_delay_min", "arr_estimated_utc", "arr_actual_utc",
    "arr_delay_min",
]
NOTAM_KEY = ["notam_number"]
NOTAM_MUTABLE = [
    "location_icao", "class", "start_utc", "end_utc", "condition_text", "ingestion_ts_utc",
]
AIRPORT_KEY = ["iata_code"]
AIRPORT_MUTABLE = [
    "icao_code", "name", "type", "latitude_deg", "longitude_deg", "elevation_ft",
    "iso_region", "municipality",
]

# --------------------------------------------------------------------- gold
# Output table of the feature build: name -> type, in table order (fixed values).
GOLD_REGISTRY = {
    "flight_iata": S, "dep_scheduled_utc": TS,
    "dep_iata": S, "arr_iata": S, "airline_iata": S, "airline_icao": S,
    "status": S, "dep_terminal": S, "flight_number": S,
    "dep_delay_min": I, "is_delayed": B,
    "hour_of_day": SH, "day_of_week": SH, "month": SH, "season": S, "is_weekend": B,
    "dep_airport_type": S, "dep_latitude": DBL, "dep_longitude": DBL,
    "dep_elevation_ft": I, "dep_iso_country": S, "dep_iso_region": S,
    "dep_municipality": S, "dep_scheduled_service": B,
    "arr_airport_type": S, "arr_latitude": DBL, "arr_longitude": DBL,
    "arr_elevation_ft": I, "arr_iso_country": S, "arr_iso_region": S,
    "arr_municipality": S, "arr_scheduled_service": B,
    "route_distance_km": DBL, "is_domestic": B, "is_international": B,
    "route_avg_delay_7d": DBL, "route_avg_delay_30d": DBL, "route_delay_rate_7d": DBL,
    "airline_avg_delay_7d": DBL, "airline_avg_delay_30d": DBL, "airline_delay_rate_7d": DBL,
    "dep_airport_avg_delay_7d": DBL, "dep_airport_avg_delay_30d": DBL,
    "dep_airport_delay_rate_7d": DBL,
    "notam_count_dep": L, "notam_count_arr": L, "notam_count_route": L,
    "notam_active_dep": L, "notam_active_arr": L,
    "has_restriction_dep": B, "has_restriction_arr": B,
    "has_parachute_activity_dep": B, "has_military_exercise_dep": B,
    "has_runway_closure_dep": B, "has_runway_closure_arr": B,
    "has_airspace_restriction": B,
    "notam_max_hours_dep": DBL, "notam_max_hours_arr": DBL,
    "dep_notams_available": B, "arr_notams_available": B,
    "flights_dep_same_hour": L, "flights_arr_same_hour": L,
}
GOLD_KEY = ["flight_iata", "dep_scheduled_utc"]

# Airports whose notices are collected (fixed values).
MONITORED_AIRPORTS = ["ALA", "CIT", "GUW", "NQZ", "SCO"]

ROLLING_COLUMNS = [
    "route_avg_delay_7d", "route_avg_delay_30d", "route_delay_rate_7d",
    "airline_avg_delay_7d", "airline_avg_delay_30d", "airline_delay_rate_7d",
    "dep_airport_avg_delay_7d", "dep_airport_avg_delay_30d", "dep_airport_delay_rate_7d",
]

# ----------------------------------------------------------------- modelling
TARGET_CLASS = "is_delayed"
TARGET_MINUTES = "dep_delay_min"
TIME_COLUMN = "dep_scheduled_utc"
DELAY_THRESHOLD_MINUTES = 15

# Columns that must never reach a model, and raw columns that their grouped
# version replaces (fixed values).
FORBIDDEN_FEATURES = [
    "is_delayed", "is_delayed_int", "dep_delay_min", "status", "updated_at",
    "dep_scheduled_utc", "flight_iata", "flight_number", "airline_icao", "dep_terminal",
]
RARE_MIN_COUNTS = {
    "dep_iata": 20, "arr_iata": 20, "airline_iata": 15, "route": 10,
    "dep_iso_country": 20, "arr_iso_country": 20,
}
