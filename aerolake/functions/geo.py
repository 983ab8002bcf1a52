"""Coordinate text parsing and orientation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..codes import LAT_MAX, LAT_MIN, LON_MAX, LON_MIN

# Plain decimal number: Spark's cast would also take '1d', 'NaN' or 'Infinity'.
NUMBER_PATTERN = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_number(text: Column) -> Column:
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def parse_coordinates(text: Column | str) -> tuple[Column, Column]:
    """``"a, b"`` → (a, b) as doubles: whitespace removed, split on ``,``,
    first two parts; malformed parts are null."""
    parts = F.split(F.regexp_replace(_c(text), r"\s+", ""), ",")
    return parse_number(F.get(parts, 0)), parse_number(F.get(parts, 1))


def with_lon_lat(df, text: Column | str, lon_name: str, lat_name: str, fmt: str = "auto"):
    """Add ``lon_name``/``lat_name`` parsed and oriented from coordinate text.

    Built as stacked projections (split once, parse each part once, then
    orient) so the parse is not repeated inside ``orient`` and the box test;
    Catalyst keeps non-cheap expressions that are used several times in their
    own projection instead of inlining them.
    """
    parts, a, b = f"__{lon_name}_parts", f"__{lon_name}_a", f"__{lon_name}_b"
    out = df.withColumn(parts, F.split(F.regexp_replace(_c(text), r"\s+", ""), ","))
    out = out.withColumns({a: parse_number(F.get(F.col(parts), 0)),
                           b: parse_number(F.get(F.col(parts), 1))})
    lon, lat = orient(F.col(a), F.col(b), fmt)
    return out.withColumns({lon_name: lon, lat_name: lat}).drop(parts, a, b)


def in_box(lon: Column, lat: Column, lon_min: float = LON_MIN, lon_max: float = LON_MAX,
           lat_min: float = LAT_MIN, lat_max: float = LAT_MAX) -> Column:
    return (lon.isNotNull() & lat.isNotNull()
            & lon.between(lon_min, lon_max) & lat.between(lat_min, lat_max))


def orient(a: Column, b: Column, fmt: str = "auto") -> tuple[Column, Column]:
    """Return (lon, lat) from the two parsed numbers.

    ``lon,lat`` keeps the order, ``lat,lon`` swaps it, ``auto`` keeps it when
    ``a`` is a plausible longitude and ``b`` a plausible latitude inside the
    box and swaps otherwise (both in [-34, -28] is ambiguous and kept).
    """
    if fmt == "lon,lat":
        return a, b
    if fmt == "lat,lon":
        return b, a
    if fmt != "auto":
        raise ValueError(f"unknown coordinate format: {fmt!r}")
    keep = a.between(LON_MIN, LON_MAX) & b.between(LAT_MIN, LAT_MAX)
    return F.when(keep, a).otherwise(b), F.when(keep, b).otherwise(a)
