"""Filters on the article table, applied before any scoring."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# ---- fixed values -------------------------------------------------------------------
MAX_QUERY_TERMS = 1024
KM_PER_DEGREE = 111.2
DEFAULT_DISTANCE_KM = 10.0


def check_terms(terms: Sequence[str]) -> list[str]:
    """Distinct lower-cased query terms in their order; too many is an error."""
    distinct = list(dict.fromkeys(t.lower() for t in terms if t))
    if len(distinct) > MAX_QUERY_TERMS:
        raise ValueError(f"query has {len(distinct)} terms, at most {MAX_QUERY_TERMS} are allowed")
    return distinct


def field_is(field: str, value) -> Column:
    """Exact match, also against any element when ``field`` is wrapped by ``any_is``."""
    return F.col(field) == F.lit(value)


def any_is(field: str, value) -> Column:
    """Exact match against any element of a multi-valued field."""
    return F.array_contains(F.col(field), value)


def in_range(field: str, low=None, high=None, include_low: bool = True, include_high: bool = False) -> Column:
    """Range with either end open (None) and either bracket inclusive or exclusive."""
    value = F.col(field)
    test = value.isNotNull()
    if low is not None:
        test = test & (value >= F.lit(low) if include_low else value > F.lit(low))
    if high is not None:
        test = test & (value <= F.lit(high) if include_high else value < F.lit(high))
    return test


def ids_in(ids: Sequence, field: str = "id") -> Column:
    return F.col(field).isin(*ids)


def match_all() -> Column:
    return F.lit(True)


def breadcrumb(filters: Sequence[Column], keep: int) -> list[Column]:
    """The first ``keep`` filters of a trail; later ones are dropped."""
    return list(filters[:keep])


def apply_filters(df: DataFrame, filters: Sequence[Column] = (), always: Sequence[Column] = ()) -> DataFrame:
    """All filters must hold; ``always`` are added on the service side to every request."""
    for test in [*filters, *always]:
        df = df.where(test)
    return df


def get_by_ids(df: DataFrame, ids: Sequence, key: str = "id") -> DataFrame:
    return df.where(ids_in(ids, key))


def bounding_box(
    lat_field: str, lon_field: str, lat: float, lon: float, distance_km: float = DEFAULT_DISTANCE_KM
) -> Column:
    """Inside the latitude/longitude box that encloses a circle around a point.

    The box's edges are constants of the plan, so plain comparisons reach the scan.
    """
    d_lat = distance_km / KM_PER_DEGREE
    south, north = max(-90.0, lat - d_lat), min(90.0, lat + d_lat)
    test = F.col(lat_field).between(south, north)
    if south <= -90.0 or north >= 90.0:
        return test
    d_lon = distance_km / (KM_PER_DEGREE * math.cos(math.radians(lat)))
    if d_lon >= 180.0:
        return test
    west, east = lon - d_lon, lon + d_lon
    if west < -180.0:
        return test & (F.col(lon_field).between(west + 360.0, 180.0) | F.col(lon_field).between(-180.0, east))
    if east > 180.0:
        return test & (F.col(lon_field).between(west, 180.0) | F.col(lon_field).between(-180.0, east - 360.0))
    return test & F.col(lon_field).between(west, east)
