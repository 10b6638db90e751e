"""Month and day spines, and the checks of date and list arguments."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_YEAR, FIRST_SCENE_YEAR = 1981, 2000


def parse_year_month(text: str, first_year: int = FIRST_YEAR) -> tuple[int, int]:
    """``2023-08`` to (2023, 8)."""
    found = re.fullmatch(r"\s*(\d+)-(\d+)\s*", text)
    if not found or not 1 <= int(found[2]) <= 12 or int(found[1]) < first_year:
        raise ValueError(f"not a month from {first_year} on: {text}")
    return int(found[1]), int(found[2])


def year_range(year: int) -> tuple[str, str]:
    if year < FIRST_SCENE_YEAR:
        raise ValueError(f"scenes start in {FIRST_SCENE_YEAR}")
    return f"{year}-01-01", f"{year}-12-31"


def month_starts(first: Column, last: Column) -> Column:
    """First days of the months from one day's month to another's, both included; an empty array when they are reversed."""
    a, b = F.trunc(first, "month"), F.trunc(last, "month")
    return F.when(a <= b, F.sequence(a, b, F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>"))


def month_names(first: Column, last: Column) -> Column:
    return F.transform(month_starts(first, last), lambda m: F.date_format(m, "yyyy-MM"))


def month_bounds(month: Column) -> tuple[Column, Column]:
    """First and last day of ``YYYY-MM``; NULL for anything else."""
    first = F.try_to_date(F.concat(month, F.lit("-01")), "yyyy-MM-dd")
    return first, F.last_day(first)


def days_between(first: Column, last: Column) -> Column:
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))


def item_date(moment: Column, properties: Column) -> Column:
    """The item's own time, else the first ten characters of the text among its properties."""
    return F.coalesce(F.to_date(moment), F.try_to_date(F.substring(properties, 1, 10)))


def chosen(key: Column, wanted: str | None) -> Column:
    """Whether a key is in a comma-separated list, whatever its case; a blank list takes all."""
    keys = [k.strip().lower() for k in (wanted or "").split(",") if k.strip()]
    return F.lower(key).isin(keys) if keys else F.lit(True)


def resolve_source(source: str, known: dict[str, str], override: str | None = None) -> str:
    """An override wins; an unknown source is an error."""
    if override:
        return override
    if source not in known:
        raise ValueError(f"no such source: {source}")
    return known[source]
