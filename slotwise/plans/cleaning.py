"""Gold features to a modelling table: fit statistics once, then project."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from slotwise.functions.casts import binary_target, bool_like, bool_word, number
from slotwise.functions.geo import route_label
from slotwise.functions.times import cyclic, utc_text
from slotwise.operators.categories import category_counts, group_rare, grouped_profile
from slotwise.operators.constancy import NEAR_CONSTANT_SHARE, column_profile, droppable
from slotwise.operators.ranks import quantile_from_counts
from slotwise.schemas import (
    DELAY_THRESHOLD_MINUTES, FORBIDDEN_FEATURES, RARE_MIN_COUNTS, ROLLING_COLUMNS,
    TARGET_CLASS, TARGET_MINUTES, TIME_COLUMN,
)
from slotwise.session import persist_table

EXCLUDED_STATUSES = ["cancelled", "diverted"]
# Column groups of the cleaning rules (fixed values).
BOOL_COLUMNS = [
    "is_weekend", "is_domestic", "is_international", "dep_scheduled_service",
    "arr_scheduled_service", "has_restriction_dep", "has_restriction_arr",
    "has_parachute_activity_dep", "has_military_exercise_dep", "has_runway_closure_dep",
    "has_runway_closure_arr", "has_airspace_restriction", "dep_notams_available",
    "arr_notams_available",
]
ZERO_NUMBERS = [
    "notam_count_dep", "notam_count_arr", "notam_count_route", "notam_active_dep",
    "notam_active_arr", "notam_max_hours_dep", "notam_max_hours_arr",
]
ZERO_FLAGS = [
    "has_restriction_dep", "has_restriction_arr", "has_parachute_activity_dep",
    "has_military_exercise_dep", "has_runway_closure_dep", "has_runway_closure_arr",
    "has_airspace_restriction",
]
DROPPED_COLUMNS = [
    "status", "updated_at", "flight_iata", "flight_number", "airline_icao", "dep_terminal",
    "hour_of_day", "day_of_week", "month", "season",
]
ELEVATIONS = ["dep_elevation_ft", "arr_elevation_ft"]
PROTECTED = [TARGET_CLASS, TARGET_MINUTES, TIME_COLUMN]
NUMERIC_TYPES = {"tinyint", "smallint", "int", "bigint", "float", "double"}


def kinds_of(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def labelled_rows(gold: DataFrame) -> DataFrame:
    """Rows usable for training: target and time known, flight not called off."""
    missing = [c for c in PROTECTED if c not in gold.columns]
    if missing:
        raise ValueError(f"feature table lacks required columns: {missing}")
    rows = gold.dropna(subset=PROTECTED)
    if "status" in gold.columns:
        status = F.lower(F.trim(F.coalesce("status", F.lit(""))))
        rows = rows.where(~status.isin(EXCLUDED_STATUSES))
    rows = rows.withColumn(TARGET_MINUTES, number(F.col(TARGET_MINUTES)))
    if kinds_of(rows)[TIME_COLUMN] == "string":
        rows = rows.withColumn(TIME_COLUMN, F.try_to_timestamp(TIME_COLUMN))
    rows = rows.dropna(subset=[TARGET_MINUTES, TIME_COLUMN])
    late = F.col(TARGET_MINUTES) > DELAY_THRESHOLD_MINUTES
    return rows.withColumn(TARGET_CLASS, late.cast("int"))


def derive(rows: DataFrame, rolling_flags: bool = False) -> DataFrame:
    """All row-wise steps that come before the fitted ones."""
    kinds = kinds_of(rows)
    t = F.col(TIME_COLUMN)
    hour_sin, hour_cos = cyclic(F.hour(t), 24)
    dow_sin, dow_cos = cyclic(F.weekday(t), 7)
    new = {
        "dep_hour": F.hour(t),
        "dep_dayofweek": F.weekday(t),
        "dep_day": F.dayofmonth(t),
        "dep_month": F.month(t),
        "dep_is_weekend": (F.weekday(t) >= 5).cast("int"),
        "dep_hour_sin": hour_sin,
        "dep_hour_cos": hour_cos,
        "dep_dow_sin": dow_sin,
        "dep_dow_cos": dow_cos,
    }
    if "dep_iata" in kinds and "arr_iata" in kinds:
        new["route"] = route_label(F.col("dep_iata"), F.col("arr_iata"))
    for c in BOOL_COLUMNS:
        if c in kinds:
            flag = bool_like(F.col(c), kinds[c])
            new[c] = F.coalesce(flag, F.lit(0)) if c in ZERO_FLAGS else flag
    for c in ZERO_NUMBERS:
        if c in kinds:
            new[c] = F.coalesce(number(F.col(c)), F.lit(0.0))
    for c in ELEVATIONS:
        if c in kinds:
            new[c] = number(F.col(c))
    if "dep_terminal" in kinds:
        new["dep_terminal_missing"] = F.col("dep_terminal").isNull().cast("int")
    if rolling_flags:
        for c in ROLLING_COLUMNS:
            if c in kinds:
                new[f"{c}_missing"] = F.col(c).isNull().cast("int")
    return rows.withColumns(new)


@dataclass
class CleaningPlan:
    """Fitted statistics of the cleaning. The category counts are a written table;
    everything held here is bounded by the number of columns."""

    counts: DataFrame
    rare_columns: dict[str, int]
    constant: list[str]
    near_constant: list[str]
    elevation: dict[str, float]
    medians: dict[str, float]
    rolling_flags: bool = False
    profile: list[dict] = field(default_factory=list)

    def transform(self, gold: DataFrame) -> DataFrame:
        return self.project(derive(labelled_rows(gold), self.rolling_flags))

    def project(self, derived: DataFrame) -> DataFrame:
        filled = fill_elevation(derived, self.elevation)
        keys = [c for c in ("flight_iata", TIME_COLUMN) if c in filled.columns]
        grouped = group_rare(filled, self.rare_columns, self.counts, keys)
        drops = {*DROPPED_COLUMNS, *self.constant, *self.near_constant}
        out = []
        for name, kind in grouped.dtypes:
            if name in drops or name.endswith("_int"):
                continue
            c = F.col(name)
            if name == TIME_COLUMN:
                c = utc_text(c)
            elif name == TARGET_CLASS:
                pass
            elif kind == "string":
                c = F.coalesce(c, F.lit("UNKNOWN"))
            elif name in self.medians:
                c = F.coalesce(c.cast("double"), F.lit(self.medians[name]))
            out.append(c.alias(name))
        return grouped.select(*out)


def fill_elevation(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m)) for c, m in medians.items()})


def fit_cleaning(
    gold: DataFrame,
    min_counts: dict[str, int] = RARE_MIN_COUNTS,
    near_constant_share: float = NEAR_CONSTANT_SHARE,
    rolling_flags: bool = False,
    fit_rows: DataFrame | None = None,
) -> CleaningPlan:
    """Learn rare values, dead columns and medians from ``fit_rows`` (default: all
    rows, as the published model did)."""
    derived = derive(labelled_rows(gold if fit_rows is None else fit_rows), rolling_flags)
    rare = {c: n for c, n in min_counts.items() if c in derived.columns}
    counts = persist_table(category_counts(derived, list(rare)), "category-counts")
    elevation = column_medians(derived, [c for c in ELEVATIONS if c in derived.columns])
    filled = fill_elevation(derived, elevation)
    features = [c for c in filled.columns if c not in {*PROTECTED, *DROPPED_COLUMNS}]
    profile = column_profile(filled, features) + grouped_profile(counts, rare)
    if not profile or not profile[0]["rows"]:
        raise ValueError("no valid rows left after parsing targets and statuses")
    constant, near = droppable(profile, near_constant_share)
    kinds = kinds_of(filled)
    needs_median = [
        p["feature"]
        for p in profile
        if p["missing"] and kinds.get(p["feature"]) in NUMERIC_TYPES
        and p["feature"] not in constant + near
    ]
    medians = column_medians(filled, needs_median)
    return CleaningPlan(counts, rare, constant, near, elevation, medians, rolling_flags, profile)


def column_medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact medians of many columns from one table of value counts; 0 if all NULL."""
    if not columns:
        return {}
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    counts = (
        df.select(F.explode(pairs).alias("_p"))
        .select("_p.feature", "_p.value")
        .where("value is not null")
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    found = quantile_from_counts(counts, ["feature"], "value", 0.5).collect()
    return {**dict.fromkeys(columns, 0.0), **{r["feature"]: r["quantile"] for r in found}}


# ------------------------------------------------------------ model features
@dataclass
class FeatureSet:
    """Modelling frame with its column roles; targets and time stay in ``rows``."""

    rows: DataFrame
    numeric: list[str]
    categorical: list[str]
    dropped: dict[str, list[str]]

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]


def leakage_drops(columns: list[str]) -> dict[str, list[str]]:
    """Which columns must go because they leak the target or repeat another one."""
    left = [c for c in columns if c not in FORBIDDEN_FEATURES]
    raw = [c for c in RARE_MIN_COUNTS if c in left and f"{c}_grp" in left]
    return {
        "forbidden": [c for c in FORBIDDEN_FEATURES if c in columns],
        "raw_with_group": raw,
        "helper_int": [c for c in left if c not in raw and c.endswith("_int")],
    }


def check_no_leakage(features: list[str]) -> None:
    found = [c for names in leakage_drops(features).values() for c in names]
    if found:
        raise ValueError(f"columns not allowed as features: {sorted(found)}")


def without_leakage(df: DataFrame) -> DataFrame:
    """The row set a model may see."""
    return df.drop(*[c for names in leakage_drops(df.columns).values() for c in names])


def bool_like_text_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Text columns whose known values are all t/f/true/false/0/1."""
    if not columns:
        return []
    allowed = ["t", "f", "true", "false", "0", "1"]
    found = df.agg(
        *[
            F.bool_and(F.lower(F.trim(c)).isin(allowed) | F.col(c).isNull()).alias(c)
            for c in columns
        ]
    ).first()
    return [c for c in columns if found[c]]


def prepare_features(
    cleaned: DataFrame, near_constant_share: float = NEAR_CONSTANT_SHARE
) -> FeatureSet:
    """Apply the leakage guards and the dead-column check to a cleaned table."""
    drops = leakage_drops(cleaned.columns)
    gone = {c for names in drops.values() for c in names}
    kept = [c for c in cleaned.columns if c not in gone]
    text = [c for c, kind in cleaned.dtypes if kind == "string" and c in kept]
    for c in bool_like_text_columns(cleaned, text):
        cleaned = cleaned.withColumn(c, bool_word(F.col(c)))
    constant, near = droppable(column_profile(cleaned, kept), near_constant_share)
    kept = [c for c in kept if c not in constant + near]
    check_no_leakage(kept)
    kinds = kinds_of(cleaned)
    numeric = [c for c in kept if kinds[c] in NUMERIC_TYPES or kinds[c] == "boolean"]
    categorical = [c for c in kept if kinds[c] == "string"]
    keep = [*[c for c in PROTECTED if c in cleaned.columns], *numeric, *categorical]
    return FeatureSet(
        cleaned.select(*keep),
        numeric,
        categorical,
        {**drops, "constant": constant, "near_constant": near},
    )


def validate_training_rows(df: DataFrame) -> dict[str, int]:
    """Fail unless targets and time are valid: class exactly {0, 1}, minutes not
    negative, time parseable. One aggregation pass."""
    missing = [c for c in PROTECTED if c not in df.columns]
    if missing:
        raise ValueError(f"training data lacks required columns: {missing}")
    kinds = kinds_of(df)
    cls = binary_target(F.col(TARGET_CLASS), kinds[TARGET_CLASS])
    minutes = number(F.col(TARGET_MINUTES))
    time = F.try_to_timestamp(F.col(TIME_COLUMN).cast("string"))
    facts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(cls.isNull() | minutes.isNull() | time.isNull()).alias("invalid"),
        F.count_if(cls == 0).alias("zeros"),
        F.count_if(cls == 1).alias("ones"),
        F.count_if(cls.isNotNull() & ~cls.isin(0, 1)).alias("other"),
        F.count_if(minutes < 0).alias("negative"),
    ).first()
    if facts["invalid"]:
        raise ValueError(f"{facts['invalid']} rows have missing or invalid required values")
    if facts["other"] or not facts["zeros"] or not facts["ones"]:
        raise ValueError(f"{TARGET_CLASS} must contain exactly the values 0 and 1")
    if facts["negative"]:
        raise ValueError(f"{TARGET_MINUTES} contains negative values")
    return facts.asDict()
