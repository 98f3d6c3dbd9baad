"""Ratios, percentages, bands and flag arithmetic."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ampflow.config import Band, BoundingBox


def is_true(flag: Column) -> Column:
    """Two-valued reading of a flag: NULL counts as FALSE."""
    return F.coalesce(flag, F.lit(False))


def any_of(flags: Sequence[Column]) -> Column:
    return reduce(or_, [is_true(f) for f in flags])


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(and_, [is_true(c) for c in conditions])


def count_of(flags: Sequence[Column]) -> Column:
    """Number of TRUE flags in the row."""
    return reduce(add, [is_true(f).cast("int") for f in flags])


def rows_where(flag: Column) -> Column:
    """Aggregate: number of rows with a TRUE flag (0, not NULL, for none)."""
    return F.count_if(is_true(flag))


def sum_where(flag: Column, value: Column) -> Column:
    return F.sum(F.when(is_true(flag), value).otherwise(0))


def positive(value: Column) -> Column:
    return F.when(value > 0, value)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient; NULL for a NULL or zero divisor."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` rounded half up to 2 decimals; NULL for an empty whole."""
    return F.round(F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double")), 2)


def round_half_even(value: Column, digits: int) -> Column:
    """Rounds the scaled double to the nearest integer, ties to even, and scales back."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def percent_half_even(part: Column, whole: Column) -> Column:
    """As :func:`percent`, with ties going to the even digit."""
    return round_half_even(ratio(part, whole) * 100, 2)


def band(value: Column, spec: Band) -> Column:
    """Label of the first limit above ``value``; NULL falls through to the default."""
    (limit, label), *rest = spec.limits
    chain = F.when(value < limit, label)
    for limit, label in rest:
        chain = chain.when(value < limit, label)
    return chain.otherwise(spec.default)


def outside_box(lat: Column, lon: Column, box: BoundingBox) -> Column:
    """TRUE when either coordinate is missing or outside the inclusive box."""
    inside = lat.between(box.lat_min, box.lat_max) & lon.between(box.lon_min, box.lon_max)
    return F.coalesce(~inside, F.lit(True))


def ends_before_start(start: Column, end: Column) -> Column:
    return F.coalesce(end < start, F.lit(False))


def lookup_key(text: Column) -> Column:
    """Spelling-insensitive join key."""
    return F.lower(F.trim(text))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere of radius 6371 km."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * 6371.0) * F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h)))
