"""Distances and grid cells as built-in expressions."""

from __future__ import annotations

# Earth radius and kilometres per mile used for all published distances.
EARTH_RADIUS_KM = 6371.7
KM_PER_MILE = 1.60934

EARTH_RADIUS_MILES = EARTH_RADIUS_KM / KM_PER_MILE


def haversine_miles(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    """SQL text: great-circle distance in miles; null when a coordinate is null."""
    half_lat, half_lng = f"sin(radians({lat2} - {lat1}) / 2)", f"sin(radians({lng2} - {lng1}) / 2)"
    a = f"{half_lat} * {half_lat} + cos(radians({lat1})) * cos(radians({lat2})) * {half_lng} * {half_lng}"
    return f"{2 * EARTH_RADIUS_KM}D * asin(sqrt({a})) / {KM_PER_MILE}D"

