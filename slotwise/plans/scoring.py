"""Batch scoring, error tables, search and lookup."""

from __future__ import annotations

from datetime import datetime, time, timedelta

from pyspark.sql import DataFrame, functions as F

from slotwise.functions.rules import error_type, risk_band, top_factors, two_stage_minutes
from slotwise.operators.categories import group_rare
from slotwise.operators.ranks import nth_keys
from slotwise.plans.cleaning import DROPPED_COLUMNS, derive, without_leakage
from slotwise.plans.gold import (
    GoldOptions, add_calendar, add_route, airport_hours, around, departing, enrich_airports, history_totals, looked_up,
    notice_columns,
)
from slotwise.plans.history import HOURLY, FlightHistory
from slotwise.plans.models import Model, with_minutes, with_probability
from slotwise.plans.silver import flatten_flights
from slotwise.schemas import FLIGHT_KEY, RARE_MIN_COUNTS
from slotwise.session import persist_table

# Values assumed when a scheduled trip has no history yet (fixed values).
PRIORS = {
    "route_distance_km": 1000.0,
    "notam_max_hours_dep": 0.0, "notam_max_hours_arr": 0.0,
    "notam_count_arr": 0, "notam_active_arr": 0,
    "has_restriction_arr": False, "has_runway_closure_arr": False,
    "dep_congestion_ratio": 1.0, "arr_congestion_ratio": 1.0,
    "route_avg_delay_7d": 10.0, "route_avg_delay_30d": 12.0, "route_delay_rate_7d": 0.15,
    "airline_avg_delay_7d": 8.0, "airline_avg_delay_30d": 10.0, "airline_delay_rate_7d": 0.12,
    "dep_airport_avg_delay_7d": 5.0, "dep_airport_avg_delay_30d": 7.0,
    "dep_airport_delay_rate_7d": 0.08,
    "dep_airport_type": "large_airport", "arr_airport_type": "large_airport",
    "dep_iso_country": "UNKNOWN", "arr_iso_country": "UNKNOWN",
    "dep_latitude": 0.0, "dep_longitude": 0.0, "arr_latitude": 0.0, "arr_longitude": 0.0,
    "dep_elevation_ft": 0, "arr_elevation_ft": 0,
    "flights_dep_same_hour": 1, "flights_arr_same_hour": 1,
}


def align(df: DataFrame, expected: dict[str, str], carry: list[str] = ()) -> DataFrame:
    """Exactly the expected columns (name -> type); absent ones are NULL."""
    return df.select(
        *carry,
        *[
            (F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c)
            for c, kind in expected.items()
        ],
    )


def answers(scored: DataFrame, threshold: float, kinds: dict[str, str]) -> DataFrame:
    """Rounded probability, label, band, minutes and factors for scored rows."""
    late = F.col("p") >= F.lit(threshold)
    extra = {
        "delay_probability": F.round("p", 6),
        "threshold": F.lit(round(threshold, 6)),
        "is_delayed": late,
        "prediction_label": F.when(late, "delayed").otherwise("on_time"),
        "risk_level": risk_band(F.col("p")),
        "top_factors": top_factors(kinds),
    }
    if "pred_min" in scored.columns:
        extra["predicted_delay_minutes_if_delayed"] = F.round(
            F.greatest(F.col("pred_min"), F.lit(0.0)), 3
        )
        extra["two_stage_predicted_delay_minutes"] = two_stage_minutes(
            late.cast("int"), F.col("pred_min")
        )
    return scored.withColumns(extra).drop("p", "pred_min")


def score(
    rows: DataFrame,
    expected: dict[str, str],
    classifier: Model,
    threshold: float,
    regressor: Model | None = None,
    carry: list[str] = (),
) -> DataFrame:
    """Score any number of rows with one or both stages."""
    scored = with_probability(classifier, align(rows, expected, carry))
    if regressor is not None:
        scored = with_minutes(regressor, scored)
    answered = answers(scored, threshold, expected)
    return answered.drop(*[c for c in expected if c not in carry])


def error_table(scored: DataFrame, threshold: float) -> DataFrame:
    """Scored test rows with the kind of error."""
    predicted = (F.col("p") >= F.lit(threshold)).cast("int")
    return scored.withColumn("y_pred_tuned", predicted).withColumn(
        "error_type", error_type(F.col("y"), F.col("y_pred_tuned"))
    )


def worst_errors(errors: DataFrame, kind: str, tie: str, k: int = 20) -> DataFrame:
    return errors.where(F.col("error_type") == kind).orderBy(F.desc("p"), F.asc(tie)).limit(k)


def regression_errors(scored: DataFrame) -> DataFrame:
    """Residual and absolute error per late row."""
    residual = F.greatest(F.col("pred_min"), F.lit(0.0)) - F.col("minutes")
    return scored.withColumns({"residual_min": residual, "absolute_error_min": F.abs(residual)})


# ------------------------------------------------------------- search, lookup
SEARCH_FIELDS = {
    "flight_iata": ["flight_iata"],
    "dep_iata": ["dep_iata", "dep_iata_grp"],
    "arr_iata": ["arr_iata", "arr_iata_grp"],
    "airline_iata": ["airline_iata", "airline_iata_grp"],
    "route": ["route", "route_grp"],
}
# Columns a search shows when the table has them (fixed values).
SEARCH_COLUMNS = [
    "row_id", "dep_scheduled_utc", "flight_iata", "dep_iata", "arr_iata", "dep_iata_grp",
    "arr_iata_grp", "airline_iata", "airline_iata_grp", "route", "route_grp", "is_delayed",
    "dep_delay_min",
]


def search(df: DataFrame, order: list[str], limit: int = 10, **wanted: str | None) -> DataFrame:
    """Rows whose fields contain all wanted texts, whatever the case, in time order.

    A wanted field without a column in the table gives no rows.
    """
    condition = F.lit(True)
    for field, text in wanted.items():
        if text is None:
            continue
        column = next((c for c in SEARCH_FIELDS[field] if c in df.columns), None)
        if column is None:
            condition = condition & F.lit(False)
        else:
            condition = condition & F.coalesce(
                F.contains(F.lower(F.col(column)), F.lower(F.lit(str(text)))), F.lit(False)
            )
    shown = [c for c in SEARCH_COLUMNS if c in df.columns]
    return df.where(condition).orderBy(*order).limit(limit).select(*shown)


def row_at(df: DataFrame, order: str, tie: str, position: int) -> DataFrame:
    """The row at a 0-based position in (order, tie), found by counting."""
    if position < 0:
        raise IndexError(f"row {position} is outside the table")
    try:
        at, tie_value = nth_keys(df, order, tie, [position])[0]
    except ValueError as error:
        raise IndexError(f"row {position} is outside the table") from error
    return df.where((F.col(order) == F.lit(at)) & (F.col(tie) == F.lit(tie_value)))


# --------------------------------------------------------- timetable features
def timetable_features(
    payloads: DataFrame,
    airports: DataFrame,
    history: DataFrame | FlightHistory,
    notams: DataFrame,
    counts: DataFrame,
    options: GoldOptions = GoldOptions(),
    carry: list[str] = (),
) -> DataFrame:
    """Scoring features for scheduled trips given as JSON payloads.

    The feature build of the training side runs on history plus timetable; what it
    cannot know yet is filled with the priors. ``counts`` are the category counts
    of the fitted cleaning plan. Of ``history`` only the days are read that the longest
    window before the timetable holds; a `FlightHistory` gives its sums instead of flights.
    """
    provenance = {"queried_airport": "string", "chunk_from": "date", "chunk_to": "date",
                  "source": "string", "ingestion_ts_utc": "timestamp"}
    raw = payloads.withColumns({c: F.lit(None).cast(t) for c, t in provenance.items()})
    trips = flatten_flights(raw, list(carry)).withColumn("dep_delay_min", F.lit(None).cast("int"))
    # Read five times, so the payloads are parsed once.
    trips = persist_table(trips, "timetable")
    due = trips.agg(F.min("dep_scheduled_utc"), F.max("dep_scheduled_utc")).first()
    first, last = [(at or datetime(1970, 1, 1)).date() for at in due]
    earlier = first - timedelta(days=max(options.windows))
    if isinstance(history, FlightHistory):
        daily, hours = history.daily(earlier, last), history.hourly(first, last)
    else:
        morning, midnight = (datetime.combine(d, time.min) for d in (first, last + timedelta(days=1)))
        daily = history_totals(departing(history, datetime.combine(earlier, time.min), midnight))
        hours = airport_hours(around(history, morning, midnight))
    # Planned trips count in their hour and make the days known; sums per key follow later.
    daily = persist_table(daily.unionByName(history_totals(trips)), "daily-totals")
    hours = hours.unionByName(airport_hours(trips)).groupBy("iata", "hour").agg(*[F.sum(c).alias(c) for c in HOURLY])
    full = looked_up(trips, daily, persist_table(hours, "airport-hours"), notams, options)
    full = add_route(notice_columns(enrich_airports(full, airports), options))
    full = full.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(v)) if c in full.columns else F.lit(v)
            for c, v in PRIORS.items()
        }
    )
    full = derive(add_calendar(full))
    grouped = group_rare(full, RARE_MIN_COUNTS, counts, FLIGHT_KEY)
    kept = without_leakage(grouped.drop(*[c for c in carry])).columns
    return grouped.select(*carry, *[c for c in kept if c not in DROPPED_COLUMNS])
