"""Exact nearest neighbour within a radius, without comparing every pair."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpi_shift.functions.geo import EARTH_RADIUS_MILES, haversine_miles
from kpi_shift.functions.lookup import lookup_join

# Positions are points in space, seen from the earth's centre. Cells are cubes some times as wide as the radius, so that a search
# sphere mostly lies in one or two; each is divided three times in ten by ten by ten blocks. The poles and the 180th meridian
# are places like any other.
CELL_RADII = 8
AXES = ("x", "y", "z")
PARTS = 10
DIVISIONS = 3
DISTANCE_DIGITS = 6
# Covers rounding of coordinates and of distances, in miles.
SLACK = 10.0 ** (1 - DISTANCE_DIGITS)


def _chord(miles: float) -> float:
    """Straight distance through the earth of two places so many miles apart."""
    return 2 * EARTH_RADIUS_MILES * math.sin(min(miles / (2 * EARTH_RADIUS_MILES), math.pi / 2))


def _in_space(df: DataFrame, lat: str, lng: str) -> DataFrame:
    """Add x, y, z in miles."""
    r = f"{EARTH_RADIUS_MILES}D"
    return df.selectExpr(
        "*",
        f"{r} * cos(radians({lat})) * cos(radians({lng})) AS x",
        f"{r} * cos(radians({lat})) * sin(radians({lng})) AS y",
        f"{r} * sin(radians({lat})) AS z",
    )


def _blocks(sites: DataFrame, by: Sequence[str], width: int) -> DataFrame:
    """Targets summed up in blocks, ``width`` finest blocks wide: their box, one position, and the block around."""
    placed = sites.selectExpr(*by, *AXES, *[f"floor(fine_{a} / {width}) AS block_{a}" for a in AXES])
    bounds = [F.expr(f"{f}({a}) AS {f}_{a}") for a in AXES for f in ("min", "max")]
    boxes = placed.groupBy(*by, *[f"block_{a}" for a in AXES]).agg(*bounds, F.expr("min(struct(x, y, z)) AS known"))
    return boxes.selectExpr("*", *[f"floor(block_{a} / {PARTS}) AS around_{a}" for a in AXES])


def _opened(pairs: DataFrame, by: Sequence[str], chord: float) -> DataFrame:
    """Of pairs of point and block, those whose block can hold the point's nearest target."""
    beside = " + ".join(f"pow(greatest(min_{a} - {a}, {a} - max_{a}, 0D), 2)" for a in AXES)
    known = " + ".join(f"pow(known.{a} - {a}, 2)" for a in AXES)
    bounded = pairs.selectExpr(
        *by, "lat", "lng", *AXES, *[f"block_{a} AS around_{a}" for a in AXES], f"sqrt({beside}) AS at_least", f"sqrt({known}) AS at_most"
    ).filter(f"at_least <= {chord + SLACK}D")
    # a point meets the blocks of a few cells, or of the few blocks left open before, so this window is bounded
    best = f"min(at_most) OVER (PARTITION BY {', '.join(by)}, lat, lng) AS best"
    near = bounded.selectExpr("*", best).filter(f"at_least <= best + {SLACK}D")
    return near.select(*by, "lat", "lng", *AXES, *[f"around_{a}" for a in AXES])


def nearest_within(
    points: DataFrame,
    targets: DataFrame,
    miles: float,
    by: Sequence[str],
    target_id: str,
) -> DataFrame:
    """For each distinct (``by``, lat, lng) of ``points``, the nearest target of the same ``by`` within ``miles``.

    ``targets`` has ``by``, ``target_id``, latitude, longitude. Distances that agree to six decimals of a mile are a
    tie, which the smaller id wins. Points with no target within reach have no row. Any place on earth will do.

    The work per point hardly grows with the number of targets around it. Targets are summed up in blocks within
    blocks. A point meets the large blocks of the cells its search sphere touches; of these, and then of the smaller ones in them,
    only those are opened that can hold something nearer than the nearest target known from the summaries. Copies of a
    position count once on both sides.
    """
    by, chord = list(by), _chord(miles)
    finest = CELL_RADII * chord / PARTS**DIVISIONS
    spots = points.select(*by, "lat", "lng").filter("lat IS NOT NULL AND lng IS NOT NULL").distinct()
    sites = (
        targets.filter("latitude IS NOT NULL AND longitude IS NOT NULL")
        .groupBy(*by, "latitude", "longitude")
        .agg(F.min(target_id).alias(target_id))
    )
    sites = _in_space(sites, "latitude", "longitude").selectExpr("*", *[f"floor({a} / {finest}D) AS fine_{a}" for a in AXES])
    around = [*by, *[f"around_{a}" for a in AXES]]
    open_blocks = _in_space(spots, "lat", "lng")
    for a in AXES:
        low, high = (f"floor(({a} {sign} {chord + SLACK}D) / {CELL_RADII * chord}D)" for sign in "-+")
        open_blocks = open_blocks.selectExpr("*", f"explode(sequence({low}, {high})) AS around_{a}")
    for division in range(1, DIVISIONS + 1):
        blocks = _blocks(sites, by, PARTS ** (DIVISIONS - division))
        open_blocks = _opened(lookup_join(open_blocks, blocks, around), by, chord)
    in_block = sites.drop(*AXES).withColumnsRenamed({f"fine_{a}": f"around_{a}" for a in AXES})
    measured = (
        lookup_join(open_blocks, in_block, around)
        .selectExpr(*by, "lat", "lng", target_id, f"{haversine_miles('lat', 'lng', 'latitude', 'longitude')} AS miles")
        .filter(f"miles <= {miles}D")
    )
    nearest = measured.groupBy(*by, "lat", "lng").agg(
        F.expr(f"min(struct(round(miles, {DISTANCE_DIGITS}) AS miles, {target_id})) AS hit")
    )
    return nearest.select(*by, "lat", "lng", f"hit.{target_id}", "hit.miles")
