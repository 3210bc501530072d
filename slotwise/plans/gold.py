"""Per-flight features for any date range in one pass."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, functions as F

from slotwise.functions.geo import haversine_km, is_domestic
from slotwise.functions.rules import TEXT_FLAGS, text_flag
from slotwise.functions.times import day_number, duration_hours, hour_bucket, is_weekend, season
from slotwise.operators.attach import attach
from slotwise.operators.intervals import stab
from slotwise.operators.trailing import from_totals, key_day_totals, rolled_up
from slotwise.operators.upsert import rewrite_partitions
from slotwise.schemas import (
    DELAY_THRESHOLD_MINUTES, FLIGHT_KEY, GOLD_KEY, GOLD_REGISTRY, MONITORED_AIRPORTS,
)
from slotwise.sources.incremental import overlapping
from slotwise.session import persist_table

if TYPE_CHECKING:
    from slotwise.plans.history import FlightHistory

# Airport column -> suffix of its dep_/arr_ copies (fixed values).
AIRPORT_ROLES = {
    "type": "airport_type", "latitude_deg": "latitude", "longitude_deg": "longitude",
    "elevation_ft": "elevation_ft", "iso_country": "iso_country", "iso_region": "iso_region",
    "municipality": "municipality", "scheduled_service": "scheduled_service",
}


@dataclass(frozen=True)
class GoldOptions:
    horizon_hours: int = 2
    windows: tuple[int, ...] = (7, 30)
    monitored: tuple[str, ...] = tuple(MONITORED_AIRPORTS)
    # Notices without an end are ignored unless this is set.
    open_ended: bool = False


def airport_role(airports: DataFrame, side: str) -> DataFrame:
    return airports.select(
        F.col("iata_code").alias(f"{side}_iata"),
        *[F.col(c).alias(f"{side}_{suffix}") for c, suffix in AIRPORT_ROLES.items()],
    )


def enrich_airports(trips: DataFrame, airports: DataFrame) -> DataFrame:
    """Both airport roles by left join. Spark broadcasts the dimension when its
    measured size allows it and splits hot codes otherwise."""
    return trips.join(airport_role(airports, "dep"), "dep_iata", "left").join(
        airport_role(airports, "arr"), "arr_iata", "left"
    )


def add_route(df: DataFrame) -> DataFrame:
    domestic = is_domestic(F.col("dep_iso_country"), F.col("arr_iso_country"))
    return df.withColumns(
        {
            "route_distance_km": haversine_km(
                F.col("dep_latitude"), F.col("dep_longitude"),
                F.col("arr_latitude"), F.col("arr_longitude"),
            ),
            "is_domestic": domestic,
            "is_international": ~domestic,
        }
    )


def add_calendar(df: DataFrame, ts: str = "dep_scheduled_utc") -> DataFrame:
    t = F.col(ts)
    return df.withColumns(
        {
            "hour_of_day": F.hour(t).cast("short"),
            "day_of_week": F.weekday(t).cast("short"),
            "month": F.month(t).cast("short"),
            "season": season(t),
            "is_weekend": is_weekend(t),
        }
    )


def airport_hours(flights: DataFrame) -> DataFrame:
    """Departures and arrivals per airport code (NULL included) and hour."""
    events = flights.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("dep_iata").alias("iata"),
                    hour_bucket(F.col("dep_scheduled_utc")).alias("hour"),
                    F.lit(1).alias("dep"), F.lit(0).alias("arr"),
                ),
                F.struct(
                    F.col("arr_iata").alias("iata"),
                    hour_bucket(F.col("arr_scheduled_utc")).alias("hour"),
                    F.lit(0).alias("dep"), F.lit(1).alias("arr"),
                ),
            )
        ).alias("e")
    ).select("e.*")
    return (
        events.where("hour is not null")
        .groupBy("iata", "hour")
        .agg(F.sum("dep").alias("flights_dep_same_hour"), F.sum("arr").alias("flights_arr_same_hour"))
    )


def notice_measures(notams: DataFrame, options: GoldOptions) -> DataFrame:
    """Notices as activity intervals in departure time: known ``horizon`` before
    departure and still valid at departure."""
    rows = notams
    if options.open_ended:
        rows = rows.withColumn(
            "end_utc", F.coalesce("end_utc", F.lit(datetime(9999, 1, 1)).cast("timestamp"))
        )
    return rows.dropna(subset=["location_icao", "start_utc", "end_utc"]).select(
        F.col("location_icao").alias("icao"),
        (F.unix_micros("start_utc") + F.lit(options.horizon_hours * 3_600_000_000)).alias("a"),
        F.unix_micros("end_utc").alias("b"),
        F.lit(1).cast("long").alias("notices"),
        *[
            text_flag(F.col("condition_text"), pattern).cast("long").alias(flag)
            for flag, pattern in TEXT_FLAGS.items()
        ],
        duration_hours(F.col("start_utc"), F.col("end_utc")).alias("max_hours"),
    )


def covered(options: GoldOptions) -> Column:
    """Whether the notices of the arrival place are known."""
    return F.coalesce(F.col("arr_iata").isin(list(options.monitored)), F.lit(False))


def notice_points(cells: DataFrame, places: tuple = ("dep_icao", "arr_icao")) -> DataFrame:
    """Distinct (place, departure time) of the ``places``; ``weight`` counts the rows
    that ask for it. Arrival places are looked up at departure time too."""
    asked = cells.select(
        F.explode(F.array(*places)).alias("icao"),
        F.unix_micros("dep_scheduled_utc").alias("at"),
    )
    return asked.dropna().groupBy("icao", "at").agg(F.count(F.lit(1)).alias("weight"))


def notice_features(points: DataFrame, notams: DataFrame, options: GoldOptions, carry: list[str] = ()) -> DataFrame:
    """Active notices per point; points without any are absent."""
    return stab(
        points, notice_measures(notams, options), "icao", "at", "a", "b",
        ["notices", *TEXT_FLAGS], ["max_hours"], carry,
    )


def add_notices(
    df: DataFrame,
    cells: DataFrame,
    notams: DataFrame,
    options: GoldOptions,
    spread_by: list[str],
    sides: tuple[str, ...] = ("dep", "arr"),
) -> DataFrame:
    """Join the notice features of the ``sides`` to ``df``, whose keys are in ``cells``. Those of the
    arrival side are looked up for covered airports only: `notice_columns` hides all others."""
    places = {"dep": F.col("dep_icao"), "arr": F.when(covered(options), F.col("arr_icao")) if "arr" in sides else None}
    points = persist_table(notice_points(cells, tuple(places[s] for s in sides)), "notice-points")
    features = persist_table(notice_features(points, notams, options, ["weight"]), "notice-features")
    for side in sides:
        keys = [f"{side}_icao", "dep_scheduled_utc"]
        weights = points.select(
            F.col("icao").alias(keys[0]),
            F.timestamp_micros("at").alias(keys[1]),
            F.col("weight").alias("_weight"),
        )
        df = attach(df, _side_of(features, side), keys, "_weight", spread_by, weights=weights)
    return df


def _side_of(features: DataFrame, side: str) -> DataFrame:
    flags = {"restriction": f"has_restriction_{side}", "runway_closed": f"has_runway_closure_{side}"}
    if side == "dep":
        flags |= {"parachute": "has_parachute_activity_dep", "military": "has_military_exercise_dep"}
    return features.select(
        F.col("icao").alias(f"{side}_icao"),
        F.timestamp_micros("at").alias("dep_scheduled_utc"),
        F.col("weight").alias("_weight"),
        F.col("notices").alias(f"notam_count_{side}"),
        F.col("notices").alias(f"notam_active_{side}"),
        F.col("max_hours").alias(f"notam_max_hours_{side}"),
        *[(F.col(flag) > 0).alias(name) for flag, name in flags.items()],
    )


def notice_columns(df: DataFrame, options: GoldOptions) -> DataFrame:
    """Defaults, route totals and the coverage mask of the arrival side."""
    known = covered(options)
    zero, false = F.lit(0).cast("long"), F.lit(False)
    count_dep, count_arr = F.coalesce("notam_count_dep", zero), F.coalesce("notam_count_arr", zero)
    restr_dep = F.coalesce("has_restriction_dep", false)
    restr_arr = F.coalesce("has_restriction_arr", false)
    return df.withColumns(
        {
            "notam_count_dep": count_dep,
            "notam_active_dep": F.coalesce("notam_active_dep", zero),
            "has_restriction_dep": restr_dep,
            "has_parachute_activity_dep": F.coalesce("has_parachute_activity_dep", false),
            "has_military_exercise_dep": F.coalesce("has_military_exercise_dep", false),
            "has_runway_closure_dep": F.coalesce("has_runway_closure_dep", false),
            "notam_count_arr": F.when(known, count_arr),
            "notam_active_arr": F.when(known, F.coalesce("notam_active_arr", zero)),
            "has_restriction_arr": F.when(known, restr_arr),
            "has_runway_closure_arr": F.when(known, F.coalesce("has_runway_closure_arr", false)),
            "notam_max_hours_arr": F.when(known, F.col("notam_max_hours_arr")),
            "notam_count_route": F.when(known, count_dep + count_arr).otherwise(count_dep),
            "has_airspace_restriction": F.when(known, restr_dep | restr_arr).otherwise(restr_dep),
            "dep_notams_available": F.coalesce(
                F.col("dep_iata").isin(list(options.monitored)), false
            ),
            "arr_notams_available": known,
        }
    )


HISTORY_KEYS = ["dep_iata", "arr_iata", "airline_iata"]
# Kinds of trailing statistics: their keys, the prefix of their columns, whether NULL keys count.
STATISTICS = (
    (["dep_iata", "arr_iata"], "route", True),
    (["airline_iata"], "airline", False),
    (["dep_iata"], "dep_airport", False),
)
# What the points of notices are made of.
POINT_KEYS = ["dep_icao", "arr_icao", "arr_iata", "dep_scheduled_utc"]


def history_totals(history: DataFrame) -> DataFrame:
    """Sums per route, carrier and day, in one pass over the history."""
    return key_day_totals(history, HISTORY_KEYS, "dep_scheduled_utc", "dep_delay_min")


def looked_up(
    flights: DataFrame, daily: DataFrame, hours: DataFrame, notams: DataFrame, options: GoldOptions
) -> DataFrame:
    """The flights with everything that depends on route, carrier and time. Few flights share all of
    these, so the lookups go to the flights themselves. ``daily`` and
    ``hours``, both read several times, are sums of the flights as `history_totals` and `airport_hours`
    make them; ``daily`` must know the days of the flights. The flights are read twice."""
    spread = FLIGHT_KEY
    out = flights.withColumns(
        {
            "day_no": day_number(F.col("dep_scheduled_utc")),
            "hour": hour_bucket(F.col("dep_scheduled_utc")),
        }
    )
    hours = hours.select(
        F.col("iata").alias("dep_iata"), "hour", "flights_dep_same_hour", "flights_arr_same_hour",
        F.col("flights_dep_same_hour").alias("_w"),
    )
    out = attach(out, hours, ["dep_iata", "hour"], "_w", spread, null_safe=True)
    for keys, prefix, null_keys in STATISTICS:
        totals = rolled_up(daily if null_keys else daily.dropna(subset=keys), keys)
        stats = from_totals(totals, keys, prefix, options.windows)
        out = attach(
            out, stats, [*keys, "day_no"], "n", spread, null_safe=null_keys, weights=totals
        )
    return add_notices(out, flights.select(*POINT_KEYS), notams, options, spread).drop("day_no", "hour")


def departing(flights: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Flights scheduled in [start, end). A table partitioned by ``dep_date`` is
    also filtered by day, so that other days are not read."""
    ts = F.col("dep_scheduled_utc")
    rows = flights.where((ts >= F.lit(start)) & (ts < F.lit(end)))
    if "dep_date" in flights.columns:
        rows = rows.where(F.col("dep_date").between(F.lit(start.date()), F.lit(end.date())))
    return rows


def around(flights: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Departures of [start, end), and its arrivals whichever day they left: the row groups
    of other days are skipped by their arrival times."""
    dep, arr = F.col("dep_scheduled_utc"), F.col("arr_scheduled_utc")
    first, last = F.lit(start), F.lit(end)
    return flights.where(((dep >= first) & (dep < last)) | ((arr >= first) & (arr < last)))


def build_features(
    flights: DataFrame,
    airports: DataFrame,
    notams: DataFrame,
    start: datetime,
    end: datetime,
    options: GoldOptions = GoldOptions(),
    history: FlightHistory | None = None,
    days: list[date] | None = None,
) -> DataFrame:
    """Gold rows for flights scheduled in [start, end), of the given ``days`` only if there are any.

    Statistics look back from the start of each flight's own day, so one call for
    a month equals one call per day. Narrow intermediate tables (points of notices,
    daily totals, notice features) are written to the shared folder on the way, so
    the flights are scanned four times, whatever the number of features. With the
    kept sums of a ``history`` only the flights of [start, end) are read, twice.
    """
    target = departing(flights, start, end).dropna(subset=["flight_iata"])
    if days is not None:
        target = target.where(F.to_date("dep_scheduled_utc").isin(days))
        if "dep_date" in target.columns:
            target = target.where(F.col("dep_date").isin(days))
    # Whole days, since statistics and hour counts know nothing smaller.
    morning = datetime.combine(start.date(), time.min)
    midnight = datetime.combine(end.date() + timedelta(days=1), time.min)
    earlier = morning - timedelta(days=max(options.windows))
    if history is None:
        daily = history_totals(departing(flights, earlier, midnight))
        hours = airport_hours(around(flights, morning, midnight))
    else:
        daily = history.daily(earlier.date(), end.date())
        hours = history.hourly(morning.date(), end.date())
    notices = (
        notams
        if options.open_ended
        else overlapping(notams, "start_utc", "end_utc", F.lit(start), F.lit(end))
    )
    full = looked_up(
        target, persist_table(daily, "daily-totals"), persist_table(hours, "airport-hours"), notices, options
    )
    full = notice_columns(add_route(enrich_airports(full, airports)), options)
    full = add_calendar(full).withColumns(
        {
            "is_delayed": F.col("dep_delay_min") > DELAY_THRESHOLD_MINUTES,
            "flights_dep_same_hour": F.coalesce("flights_dep_same_hour", F.lit(0)),
            "flights_arr_same_hour": F.coalesce("flights_arr_same_hour", F.lit(0)),
        }
    )
    return to_registry(full)


def to_registry(df: DataFrame) -> DataFrame:
    """Exactly the registry columns; absent ones are NULL."""
    return df.select(
        *[
            (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in GOLD_REGISTRY.items()
        ]
    )


def write_features(features: DataFrame, path: str, days: list[date] | None = None) -> None:
    """Upsert gold rows by key into day partitions. ``days``, where they are known, hold all rows."""
    rows = features.withColumns(
        {"updated_at": F.current_timestamp(), "dep_date": F.to_date("dep_scheduled_utc")}
    )
    mutable = [c for c in rows.columns if c not in {*GOLD_KEY, "dep_date"}]
    rewrite_partitions(rows, path, GOLD_KEY, mutable, "dep_date", touched=days)
