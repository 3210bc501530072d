"""The JSON envelope of the raw feeds: provenance around the payload as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from slotwise.functions.casts import blank_to_null, iso_date, parsed_once, utc_timestamp

FLIGHT_PROVENANCE = [
    "ingestion_ts_utc", "queried_airport", "query_direction", "chunk_from", "chunk_to", "source",
]
NOTAM_PROVENANCE = [
    "ingestion_ts_utc", "queried_airport", "chunk_from", "chunk_to", "source", "source_endpoint",
]


def _part(col: Column, *path: str) -> Column:
    for name in path:
        col = col.getField(name)
    return col


def flight_key(payload: Column) -> Column:
    """Routing key of a flight; missing and empty parts count as ``unknown``."""
    unknown = F.lit("unknown")
    number = F.coalesce(blank_to_null(_part(payload, "flight", "iataNumber")), unknown)
    when = F.coalesce(blank_to_null(_part(payload, "departure", "scheduledTime")), unknown)
    return F.md5(F.concat_ws("|", number, when))


def notam_key(payload: Column, airport: Column) -> Column:
    """Routing key of a notice; only a missing number counts as ``unknown``."""
    number = F.coalesce(payload.getField("number"), F.lit("unknown"))
    return F.md5(F.concat_ws("|", airport, number))


def wrap(records: DataFrame, payload: str, provenance: list[str], key: Column) -> DataFrame:
    """Rows ready for a topic or a landing folder: ``key`` and JSON ``value``."""
    body = F.struct(*provenance, F.col(payload).alias("payload"))
    return records.select(key.alias("key"), F.to_json(body).alias("value"))


def decode(raw: DataFrame, provenance: list[str], value: str = "value") -> DataFrame:
    """Split an envelope into typed provenance columns and the payload text.

    ``decoded`` is false for values that are not a JSON object. The payload is
    carried along as text with its order of keys, repeated keys and long integers, so fields
    nobody knows yet survive; blanks between tokens go and fractions are spelled anew (1.10
    as 1.1). A payload that is a plain JSON string comes without its quotes, none as ``{}``.
    """
    fields = ", ".join(f"{c} string" for c in provenance)
    envelope = F.from_json(F.col(value), f"{fields}, payload string, _bad string", {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad",
    })
    is_object = F.col(value).rlike(r"^\s*\{")
    parsed = parsed_once(raw, "_e", envelope)
    typed = {
        "ingestion_ts_utc": utc_timestamp, "chunk_from": iso_date, "chunk_to": iso_date,
    }
    return parsed.select(
        *raw.columns,
        F.coalesce(is_object & F.col("_e").isNotNull() & F.col("_e._bad").isNull(), F.lit(False))
        .alias("decoded"),
        *[typed.get(c, lambda x: x)(F.col(f"_e.{c}")).alias(c) for c in provenance],
        F.coalesce(F.col("_e.payload"), F.lit("{}")).alias("payload"),
    )


def split_decoded(decoded: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Good rows without the raw text, and the raw text of the bad ones."""
    good = decoded.where("decoded").drop("decoded", value)
    bad = decoded.where("not decoded").select(value)
    return good, bad
