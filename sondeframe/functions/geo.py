"""Points, boxes, cells and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sondeframe import config as C


def in_box(lon: Column, lat: Column, box: tuple[float, float, float, float]) -> Column:
    west, south, east, north = box
    return lon.between(west, east) & lat.between(south, north)


def region(lon: Column, lat: Column, strict: bool = True) -> Column:
    """OOD, delta, north coast, shelf in that order; outside all an error, or NULL when not strict."""
    outside = F.raise_error(F.concat(F.lit("outside all regions: "), lon.cast("string"), F.lit(","), lat.cast("string"))) if strict else F.lit(None)
    return (
        F.when(in_box(lon, lat, C.OOD), "ood_nw_africa").when(in_box(lon, lat, C.DELTA), "delta")
        .when(in_box(lon, lat, C.N_COAST), "n_coast").when(in_box(lon, lat, C.ROI), "em_shelf").otherwise(outside)
    )


def patch_region(lon: Column, lat: Column) -> Column:
    """Delta, north coast, else shelf, without a look at the outer boxes."""
    return F.when(in_box(lon, lat, C.DELTA), "delta").when(in_box(lon, lat, C.N_COAST), "n_coast").otherwise("em_shelf")


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * C.EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def cell(lon: Column, lat: Column) -> tuple[Column, Column]:
    """South-west corner of the one-degree cell."""
    return F.floor(lon).cast("int"), F.floor(lat).cast("int")


def to_cell_km(lon: Column, lat: Column, cell_lon: Column, cell_lat: Column, size: float = C.CELL_DEG) -> Column:
    """Distance to the nearest point of a cell."""
    x = F.greatest(cell_lon.cast("double"), F.least(cell_lon + size, lon))
    y = F.greatest(cell_lat.cast("double"), F.least(cell_lat + size, lat))
    return haversine_km(lon, lat, x, y)


def epsg_of_tile(tile: Column) -> Column:
    """T36RUU -> 32636; bands from N on are northern.  A zone outside 1..60 is an error."""
    zone = F.regexp_extract(tile, r"^T?(\d{1,2})([A-Z])", 1).cast("int")
    band = F.regexp_extract(tile, r"^T?(\d{1,2})([A-Z])", 2)
    good = F.when(zone.between(1, 60), zone).otherwise(F.raise_error(F.concat(F.lit("no such zone: "), tile)))
    return F.when(band >= "N", 32600 + good).otherwise(32700 + good)


def sinusoidal(lon: Column, lat: Column, radius: float = C.SINUSOIDAL_R) -> tuple[Column, Column]:
    return radius * F.radians(lon) * F.cos(F.radians(lat)), radius * F.radians(lat)


def from_sinusoidal(x: Column, y: Column, radius: float = C.SINUSOIDAL_R) -> tuple[Column, Column]:
    lat = y / radius
    return F.degrees(x / (radius * F.cos(lat))), F.degrees(lat)
