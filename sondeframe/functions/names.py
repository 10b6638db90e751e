"""Parsing and making of scene ids, file names and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def part(scene_id: Column, i: int) -> Column:
    return F.get(F.split(scene_id, r"\."), F.lit(i))


def sensor_of(scene_id: Column) -> Column:
    return F.when(part(scene_id, 1).isin("S30", "L30"), part(scene_id, 1))


def tile_of(scene_id: Column) -> Column:
    return F.when(part(scene_id, 2).startswith("T"), part(scene_id, 2))


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """The first match's group, or NULL."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def doy_date(year: Column, doy: Column) -> Column:
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), doy - 1)


def scene_date(name: Column) -> Column:
    """``.YYYYDDDT``; a day outside 1..366 is NULL, 366 of a common year is the next January 1."""
    year, doy = found(name, r"\.(\d{4})\d{3}T").cast("int"), found(name, r"\.\d{4}(\d{3})T").cast("int")
    return F.when(doy.between(1, 366), doy_date(year, doy))


def composite_year_doy(name: Column) -> tuple[Column, Column]:
    return found(name, r"\.A(\d{4})\d{3}\.").cast("int"), found(name, r"\.A\d{4}(\d{3})\.").cast("int")


def grid_tile(name: Column) -> Column:
    return found(name, r"h\d{2}v\d{2}", 0)


def is_terra(name: Column) -> Column:
    return F.upper(name).startswith("MOD")


def label_date(name: Column) -> Column:
    return F.try_to_date(found(name, r"(\d{4}-\d{2}-\d{2})"))


def sample_id(tile: Column, day: Column, row: Column, col: Column) -> Column:
    return F.format_string("%s_%s_r%02dc%02d", tile, day.cast("string"), row, col)


def cell_key(lon: Column, lat: Column) -> Column:
    return F.concat_ws("_", lon.cast("string"), lat.cast("string"))


def parse_cell_key(key: Column) -> tuple[Column, Column]:
    return F.split(key, "_")[0].cast("int"), F.split(key, "_")[1].cast("int")


def band_path(red_path: Column, code: str) -> Column:
    return F.replace(red_path, F.lit(".B04."), F.lit(f".{code}."))


def image_path(tile: Column, day: Column) -> Column:
    return F.format_string("tiles_%s_%d.zarr::image", tile, F.year(day))


def month_file(year: Column, month: Column, stem: str = "precip") -> Column:
    return F.format_string(stem + ".%04d.%02d.nc", year, month)


def band_hrefs(assets: Column, sensor: Column, bands: dict[str, dict[str, str]]) -> Column:
    """band -> href; NULL when the sensor is unknown or any band or the mask is missing."""
    out = F.lit(None).cast("map<string,string>")
    for name, codes in bands.items():
        codes = codes | {"fmask": "Fmask"}
        links = F.array(*[F.try_element_at(assets, F.lit(c)) for c in codes.values()])
        whole = ~F.exists(links, lambda x: x.isNull())
        out = F.when((sensor == name) & whole, F.map_from_arrays(F.array(*map(F.lit, codes)), links)).otherwise(out)
    return out


def pick_asset(keys: Column, pattern: str) -> Column:
    """Exact case-insensitive match, else the first that contains the pattern, else NULL."""
    want = pattern.upper()
    exact = F.filter(keys, lambda k: F.upper(k) == want)
    inside = F.filter(keys, lambda k: F.upper(k).contains(want))
    return F.coalesce(F.get(exact, F.lit(0)), F.get(inside, F.lit(0)))


def clean_text(c: Column) -> Column:
    """Text with every part that isn't valid UTF-8 replaced by the replacement character."""
    return F.make_valid_utf8(c)
