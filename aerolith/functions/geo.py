"""Nearest centroid as a row-local expression: no join, no shuffle."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolith.constants import REGION_CENTROIDS

# Up to so many centroids are compared in generated code; more of them as an array, whose size code doesn't depend on.
INLINE_CENTROIDS = 64


def planar_distance_sq(lat1, lon1, lat2, lon2):
    """Squared distance in degrees on the plane."""
    return (lat1 - lat2) * (lat1 - lat2) + (lon1 - lon2) * (lon1 - lon2)


def nearest_region(
    latitude: Column,
    longitude: Column,
    centroids: Sequence[tuple[str, float, float]] = REGION_CENTROIDS,
    unmatched: str = "null",
) -> Column:
    """Name of the closest centroid; on a tie, the one listed first.

    A reading without coordinates gets NULL, or the first centroid if ``unmatched="first"``.
    Every row is compared with every centroid, in the row: no join, whatever their number.
    """
    if not centroids:
        raise ValueError("nearest_region takes at least one centroid")
    if unmatched not in ("null", "first"):
        raise ValueError("unmatched is 'null' or 'first'")
    missing = F.lit(None).cast("double")
    lat, lon = F.nanvl(latitude, missing), F.nanvl(longitude, missing)
    if len(centroids) > INLINE_CENTROIDS:
        nearest = _nearest_of_array(lat, lon, centroids)
        return F.coalesce(nearest, F.lit(centroids[0][0])) if unmatched == "first" else nearest
    distances = [planar_distance_sq(lat, lon, F.lit(clat), F.lit(clon)) for _, clat, clon in centroids]
    closest = F.least(*distances) if len(distances) > 1 else distances[0]
    name = None
    for (region, _, _), distance in zip(centroids, distances):
        hit = distance == closest
        name = F.when(hit, region) if name is None else name.when(hit, region)
    return name.otherwise(F.lit(centroids[0][0])) if unmatched == "first" else name


def _nearest_of_array(lat: Column, lon: Column, centroids: Sequence[tuple[str, float, float]]) -> Column:
    rows = [{"place": i, "name": name, "lat": clat, "lon": clon} for i, (name, clat, clon) in enumerate(centroids)]
    table = F.from_json(F.lit(json.dumps(rows)), "array<struct<place:int,name:string,lat:double,lon:double>>")  # folded once
    near = F.array_min(
        F.transform(table, lambda c: F.struct(planar_distance_sq(lat, lon, c["lat"], c["lon"]).alias("d"), c["place"], c["name"]))
    )
    return F.when(lat.isNotNull() & lon.isNotNull(), near["name"])


def centroid_latitude(region: Column) -> Column:
    return _centroid_field(region, 1)


def centroid_longitude(region: Column) -> Column:
    return _centroid_field(region, 2)


def _centroid_field(region: Column, position: int) -> Column:
    value = None
    for row in REGION_CENTROIDS:
        value = F.when(region == row[0], row[position]) if value is None else value.when(region == row[0], row[position])
    return value
