"""Stress indicators and the class rule, as Column expressions.  Missing values are NULL throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sondeframe import config as C


def nan_to_null(c: Column) -> Column:
    """NaN sorts above everything in Spark; NULL makes a comparison false, as the rules need."""
    return F.when(~F.isnan(c), c)


def fill_to_null(c: Column, fill: float) -> Column:
    return F.when(c != fill, c)


def ratio_index(num: Column, den: Column) -> Column:
    """100 num / den within 0..100; NULL if either is missing or the denominator isn't positive."""
    return F.when((den > 0) & num.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100.0 * num / den)))


def vci(ndvi: Column, low: Column, high: Column) -> Column:
    return ratio_index(ndvi - low, high - low)


def tci(lst: Column, low: Column, high: Column) -> Column:
    return ratio_index(high - lst, high - low)


def vhi(vci_: Column, tci_: Column) -> Column:
    return 0.5 * vci_ + 0.5 * tci_


def zscore(v: Column, mean: Column, std: Column) -> Column:
    return F.when(std > 0, (v - mean) / std)


def classify(spei: Column, tmax_z: Column, vhi_: Column) -> Column:
    """Compound over heat over drought over none; a missing indicator meets no condition."""
    dry, hot, weak = spei < C.SPEI_MAX, tmax_z > C.TMAX_Z_MIN, vhi_ < C.VHI_MAX
    return F.when(dry & hot & weak, C.COMPOUND).when(hot, C.HEAT).when(dry, C.DROUGHT).otherwise(C.NONE)


def masked_class(spei: Column, tmax_z: Column, vhi_: Column) -> Column:
    """The class where all three indicators exist, else 255."""
    there = spei.isNotNull() & tmax_z.isNotNull() & vhi_.isNotNull()
    return F.when(there, classify(spei, tmax_z, vhi_)).otherwise(C.NODATA)


def label_columns(ndvi, ndvi_lo, ndvi_hi, lst, lst_lo, lst_hi, wb3, wb_mean, wb_std, tmax, t_mean, t_std) -> dict[str, Column]:
    """Indicators from twelve raster columns."""
    return {
        "spei3": zscore(wb3, wb_mean, wb_std),
        "tmax_z": zscore(tmax, t_mean, t_std),
        "vhi": vhi(vci(ndvi, ndvi_lo, ndvi_hi), tci(lst, lst_lo, lst_hi)),
    }


def valid_product(product: Column, v: Column) -> Column:
    """Vegetation index within -2000..10000; surface temperature above 0."""
    return F.when(product == "MOD13Q1", v.between(-2000, 10000)).otherwise(v > 0)


def cloudy(fmask: Column) -> Column:
    return fmask.bitwiseAND(F.lit(C.CLOUD_BITS)) != 0


def extraterrestrial(lat: Column, doy: Column) -> Column:
    """FAO-56 equation 21, MJ m-2 day-1."""
    phi = F.radians(lat)
    turn = 2 * F.pi() * doy / 365
    near = 1 + 0.033 * F.cos(turn)
    tilt = 0.409 * F.sin(turn - 1.39)
    sunset = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -F.tan(phi) * F.tan(tilt))))
    swing = sunset * F.sin(phi) * F.sin(tilt) + F.cos(phi) * F.cos(tilt) * F.sin(sunset)
    return 24 * 60 / F.pi() * 0.0820 * near * swing


def hargreaves(tmax: Column, tmin: Column, ra: Column) -> Column:
    span = F.when(tmax.isNotNull() & tmin.isNotNull(), F.greatest(tmax - tmin, F.lit(0.0)))
    return 0.0023 * 0.408 * ra * ((tmax + tmin) / 2 + 17.8) * F.sqrt(span)
