"""Great-circle distance and route labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km to two decimals; NULL when a coordinate is missing."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_dlat), 2.0) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(half_dlon), 2.0)
    arc = 2 * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))
    return F.round(F.lit(EARTH_RADIUS_KM) * arc, 2)


def is_domestic(dep_country: Column, arr_country: Column) -> Column:
    """Unknown countries are not domestic."""
    return F.coalesce(dep_country == arr_country, F.lit(False))


def route_label(dep: Column, arr: Column) -> Column:
    unknown = F.lit("UNKNOWN")
    return F.concat_ws("_", F.coalesce(dep, unknown), F.coalesce(arr, unknown))
