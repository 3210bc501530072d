"""Raw payloads to typed, deduplicated tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from slotwise.functions.casts import (
    number, parsed_once, trimmed_code, upper_code, utc_timestamp, variant_int, yes_flag,
)
from slotwise.operators.upsert import keep_last
from slotwise.schemas import (
    AIRPORT_KEY, AIRPORT_TYPES, FLIGHT_KEY, FLIGHT_PAYLOAD, NOTAM_KEY, NOTAM_PAYLOAD, SILVER_AIRPORTS,
)


def _code(path: str):
    return upper_code(F.col(path))


def _time(path: str):
    return utc_timestamp(F.col(path))


def flatten_flights(raw: DataFrame, carry: list[str] = ()) -> DataFrame:
    """28 typed columns per raw flight; rows without a full key drop out."""
    p = parsed_once(raw, "_p", F.from_json("payload", FLIGHT_PAYLOAD))
    flat = p.select(
        _code("_p.flight.iataNumber").alias("flight_iata"),
        _code("_p.flight.icaoNumber").alias("flight_icao"),
        F.col("_p.flight.number").alias("flight_number"),
        F.col("_p.airline.name").alias("airline_name"),
        _code("_p.airline.iataCode").alias("airline_iata"),
        _code("_p.airline.icaoCode").alias("airline_icao"),
        F.col("_p.status").alias("status"),
        _code("_p.departure.iataCode").alias("dep_iata"),
        _code("_p.departure.icaoCode").alias("dep_icao"),
        F.col("_p.departure.terminal").alias("dep_terminal"),
        _time("_p.departure.scheduledTime").alias("dep_scheduled_utc"),
        _time("_p.departure.estimatedTime").alias("dep_estimated_utc"),
        _time("_p.departure.actualTime").alias("dep_actual_utc"),
        _time("_p.departure.estimatedRunway").alias("dep_estimated_runway_utc"),
        _time("_p.departure.actualRunway").alias("dep_actual_runway_utc"),
        variant_int(F.col("_p.departure.delay")).alias("dep_delay_min"),
        _code("_p.arrival.iataCode").alias("arr_iata"),
        _code("_p.arrival.icaoCode").alias("arr_icao"),
        F.col("_p.arrival.baggage").alias("arr_baggage"),
        _time("_p.arrival.scheduledTime").alias("arr_scheduled_utc"),
        _time("_p.arrival.estimatedTime").alias("arr_estimated_utc"),
        _time("_p.arrival.actualTime").alias("arr_actual_utc"),
        variant_int(F.col("_p.arrival.delay")).alias("arr_delay_min"),
        "queried_airport", "chunk_from", "chunk_to", "source", "ingestion_ts_utc", *carry,
    )
    return flat.dropna(subset=FLIGHT_KEY)


def flatten_notams(raw: DataFrame, carry: list[str] = ()) -> DataFrame:
    """Typed notices; rows without a number drop out."""
    p = parsed_once(raw, "_p", F.from_json("payload", NOTAM_PAYLOAD))
    flat = p.select(
        trimmed_code(F.col("_p.number")).alias("notam_number"),
        _code("_p.location").alias("location_icao"),
        F.col("_p.class").alias("class"),
        _time("_p.startdateutc").alias("start_utc"),
        _time("_p.enddateutc").alias("end_utc"),
        F.col("_p.condition").alias("condition_text"),
        "queried_airport", "source", "ingestion_ts_utc", *carry,
    )
    return flat.dropna(subset=NOTAM_KEY)


def clean_airports(raw: DataFrame, carry: list[str] = ()) -> DataFrame:
    """Typed airports of the relevant kinds that have an IATA code after trimming."""
    typed = raw.where(F.col("type").isin(AIRPORT_TYPES)).select(
        trimmed_code(F.col("iata_code")).alias("iata_code"),
        F.upper(F.trim("icao_code")).alias("icao_code"),
        "ident", "name", "type",
        number(F.col("latitude_deg")).alias("latitude_deg"),
        number(F.col("longitude_deg")).alias("longitude_deg"),
        F.floor(number(F.col("elevation_ft"))).cast("int").alias("elevation_ft"),
        "continent", "iso_country", "iso_region", "municipality",
        yes_flag(F.col("scheduled_service")).alias("scheduled_service"),
        *carry,
    )
    return typed.dropna(subset=AIRPORT_KEY)


def latest_flights(raw: DataFrame, order: list[str]) -> DataFrame:
    return keep_last(flatten_flights(raw, order), FLIGHT_KEY, order).drop(*order)


def latest_notams(raw: DataFrame, order: list[str]) -> DataFrame:
    return keep_last(flatten_notams(raw, order), NOTAM_KEY, order).drop(*order)


def latest_airports(raw: DataFrame, order: list[str]) -> DataFrame:
    return keep_last(clean_airports(raw, order), AIRPORT_KEY, order).select(SILVER_AIRPORTS.names)


def duplicate_icao(airports: DataFrame) -> DataFrame:
    """ICAO codes that more than one airport claims, for the quality report."""
    return (
        airports.where("icao_code is not null")
        .groupBy("icao_code")
        .agg(F.count(F.lit(1)).alias("airports"))
        .where("airports > 1")
    )
