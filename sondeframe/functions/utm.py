"""UTM by the Krueger series and MGRS 100 km squares, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# WGS84 and UTM.
A, FLAT, K0, FALSE_E, FALSE_N = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10000000.0
N = FLAT / (2 - FLAT)
RECT = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64 + N**6 / 256)
ALPHA = (
    N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16 + 41 * N**4 / 180, 13 * N**2 / 48 - 3 * N**3 / 5 + 557 * N**4 / 1440,
    61 * N**3 / 240 - 103 * N**4 / 140, 49561 * N**4 / 161280,
)
BETA = (
    N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96 - N**4 / 360, N**2 / 48 + N**3 / 15 - 437 * N**4 / 1440,
    17 * N**3 / 480 - 37 * N**4 / 840, 4397 * N**4 / 161280,
)
DELTA = (
    2 * N - 2 * N**2 / 3 - 2 * N**3 + 116 * N**4 / 45, 7 * N**2 / 3 - 8 * N**3 / 5 - 227 * N**4 / 45,
    56 * N**3 / 15 - 136 * N**4 / 35, 4279 * N**4 / 630,
)
ECC = (FLAT * (2 - FLAT)) ** 0.5


def zone_of(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1).cast("int")


def _centre(zone, m=F):
    return m.radians(zone * 6.0 - 183.0)


def _conformal(lat: Column) -> Column:
    phi = F.radians(lat)
    return F.sinh(F.atanh(F.sin(phi)) - ECC * F.atanh(ECC * F.sin(phi)))


def _sphere(t: Column, lam: Column) -> tuple[Column, Column]:
    return F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))


def _plane(xi: Column, eta: Column, lat: Column) -> tuple[Column, Column]:
    east = eta + sum(a * F.cos(2 * j * xi) * F.sinh(2 * j * eta) for j, a in enumerate(ALPHA, 1))
    north = xi + sum(a * F.sin(2 * j * xi) * F.cosh(2 * j * eta) for j, a in enumerate(ALPHA, 1))
    return FALSE_E + K0 * RECT * east, F.when(lat < 0, FALSE_N).otherwise(0.0) + K0 * RECT * north


def forward(lon: Column, lat: Column, zone: Column) -> tuple[Column, Column]:
    """Easting and northing in a zone (northern false northing 0)."""
    return _plane(*_sphere(_conformal(lat), F.radians(lon) - _centre(zone)), lat)


def projected(points: DataFrame) -> DataFrame:
    """``points(lon, lat, ...)`` with ``zone, east, north``, the values of ``forward``.

    Made step by step, a column each: written as one expression, the parts that the series
    repeat are evaluated anew for each of their terms.
    """
    df = points.withColumn("zone", zone_of(F.col("lon"))).withColumn("_t", _conformal(F.col("lat")))
    df = df.withColumn("_lam", F.radians(F.col("lon")) - _centre(F.col("zone")))
    xi, eta = _sphere(F.col("_t"), F.col("_lam"))
    east, north = _plane(F.col("_xi"), F.col("_eta"), F.col("lat"))
    return df.withColumns({"_xi": xi, "_eta": eta}).withColumns({"east": east, "north": north}).drop("_t", "_lam", "_xi", "_eta")


def inverse(east, north, zone, south: bool = False, m=F):
    """Longitude and latitude: of columns, or of numbers and arrays with ``m`` as ``math`` or ``numpy``."""
    xi = (north - (FALSE_N if south else 0.0)) / (K0 * RECT)
    eta = (east - FALSE_E) / (K0 * RECT)
    xi1 = xi - sum(b * m.sin(2 * j * xi) * m.cosh(2 * j * eta) for j, b in enumerate(BETA, 1))
    eta1 = eta - sum(b * m.cos(2 * j * xi) * m.sinh(2 * j * eta) for j, b in enumerate(BETA, 1))
    chi = m.asin(m.sin(xi1) / m.cosh(eta1))
    lat = chi + sum(d * m.sin(2 * j * chi) for j, d in enumerate(DELTA, 1))
    return m.degrees(_centre(zone, m) + m.atan2(m.sinh(eta1), m.cos(xi1))), m.degrees(lat)


def mgrs_square(lon: Column, lat: Column) -> Column:
    """100 km square such as T36RUU, for latitudes -80..84 outside the northern exceptions."""
    zone = zone_of(lon)
    return square_name(zone, *forward(lon, lat, zone), lat)


def square_name(zone: Column, east: Column, north: Column, lat: Column) -> Column:
    """The 100 km square of a projected point."""
    bands, rows = "CDEFGHJKLMNPQRSTUVWX", "ABCDEFGHJKLMNPQRSTUV"
    band = F.lit(bands).substr((F.least(F.floor((lat + 80) / 8), F.lit(19)) + 1).cast("int"), F.lit(1))
    columns = F.when(zone % 3 == 1, "ABCDEFGH").when(zone % 3 == 2, "JKLMNPQR").otherwise("STUVWXYZ")
    col = columns.substr(F.floor(east / 100000).cast("int"), F.lit(1))
    shift = F.when(zone % 2 == 0, 5).otherwise(0)
    row = F.lit(rows).substr((F.pmod(F.floor(north / 100000) + shift, F.lit(20)) + 1).cast("int"), F.lit(1))
    return F.concat(F.lit("T"), F.lpad(zone.cast("string"), 2, "0"), band, col, row)


def _place(letters: Column, letter: Column) -> Column:
    return F.position(letter, letters)


def square_origin(tile: Column) -> tuple[Column, Column, Column]:
    """Zone, easting and northing of the south-west corner of a northern 100 km square such as T36RUU."""
    zone = tile.substr(2, 2).cast("int")
    # Within the lettered zone set, a column letter's place is its 100 km step.
    letters = F.when(zone % 3 == 1, "ABCDEFGH").when(zone % 3 == 2, "JKLMNPQR").otherwise("STUVWXYZ")
    east = _place(letters, tile.substr(5, 1)) * 100000.0
    shift = F.when(zone % 2 == 0, 5).otherwise(0)
    row = F.pmod(_place(F.lit("ABCDEFGHJKLMNPQRSTUV"), tile.substr(6, 1)) - 1 - shift, F.lit(20)) * 100000.0
    # Rows repeat each 2,000 km: the first that reaches into the latitude band.
    south = (_place(F.lit("CDEFGHJKLMNPQRSTUVWX"), tile.substr(4, 1)) - 1) * 8.0 - 80
    edge = K0 * RECT * (F.radians(south) - 1.5 * N * F.sin(2 * F.radians(south)))
    return zone, east, row + (F.floor((edge - 100000 - row) / 2000000) + 1) * 2000000.0
