"""Rule tables that compile to Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Notice flags: a pattern searched in the lower-cased text (fixed values).
TEXT_FLAGS = {
    "restriction": "restricted area",
    "parachute": "parachute",
    "military": "military",
    "runway_closed": "rwy clsd|runway closed",
}

# Upper bounds of the risk bands (fixed values).
RISK_BANDS = [(0.35, "low"), (0.65, "medium")]
TOP_RISK_BAND = "high"

# Explanation rules in order: columns, smallest value that fires (None = boolean),
# label. A rule fires when any of its columns does (fixed values).
FACTOR_RULES = [
    (["is_international"], None, "international flight"),
    (["route_distance_km"], 1500, "long route distance"),
    (["notam_count_route"], 5, "many route NOTAMs"),
    (["flights_dep_same_hour"], 5, "departure airport congestion"),
    (["flights_arr_same_hour"], 5, "arrival/departure airport congestion"),
    (["has_airspace_restriction"], None, "airspace restriction"),
    (["has_runway_closure_dep", "has_runway_closure_arr"], None, "runway closure"),
    (["notam_count_dep"], 3, "departure airport NOTAM activity"),
]
MAX_FACTORS = 5


def text_flag(text: Column, pattern: str) -> Column:
    return F.coalesce(F.lower(text).rlike(pattern), F.lit(False))


def risk_band(probability: Column) -> Column:
    chain = F
    for bound, name in RISK_BANDS:
        chain = chain.when(probability < bound, name)
    return chain.otherwise(TOP_RISK_BAND)


def truthy(c: Column, kind: str) -> Column:
    """Boolean reading of a feature of any type; missing is false."""
    if kind == "boolean":
        value = c
    elif kind == "string":
        value = F.lower(F.trim(c)).isin("1", "true", "yes", "y")
    else:
        value = c != 0
    return F.coalesce(value, F.lit(False))


def numeric_or_zero(c: Column) -> Column:
    value = c.try_cast("double")
    return F.when(value.isNull() | F.isnan(value), 0.0).otherwise(value)


def top_factors(kinds: dict[str, str]) -> Column:
    """First five firing rules over the columns in ``kinds`` (name -> simple type)."""
    fired = []
    for columns, minimum, label in FACTOR_RULES:
        checks = [
            truthy(F.col(name), kinds[name])
            if minimum is None
            else numeric_or_zero(F.col(name)) >= minimum
            for name in columns
            if name in kinds
        ]
        if not checks:
            continue
        hit = checks[0]
        for check in checks[1:]:
            hit = hit | check
        fired.append(F.when(hit, F.lit(label)))
    if not fired:
        return F.array().cast("array<string>")
    return F.slice(F.filter(F.array(*fired), lambda x: x.isNotNull()), 1, MAX_FACTORS)


def error_type(truth: Column, predicted: Column) -> Column:
    return (
        F.when((truth == 1) & (predicted == 0), "false_negative")
        .when((truth == 0) & (predicted == 1), "false_positive")
        .when(truth == predicted, "correct")
        .otherwise("unknown")
    )


def two_stage_minutes(predicted: Column, minutes: Column) -> Column:
    return F.when(predicted == 1, F.greatest(minutes.cast("double"), F.lit(0.0))).otherwise(0.0)


def logistic(score: Column) -> Column:
    return 1 / (1 + F.exp(-score))
