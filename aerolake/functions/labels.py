"""Derived labels: period of day, weekday name, route key / label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..codes import DAY_PERIODS, WEEKDAY_LABELS


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def day_period(hour: Column | str) -> Column:
    """[0,6) dawn, [6,12) morning, [12,18) afternoon, anything else (null too) night."""
    h = _c(hour)
    dawn, morning, afternoon, night = DAY_PERIODS
    return (F.when((h >= 0) & (h < 6), dawn)
            .when((h >= 6) & (h < 12), morning)
            .when((h >= 12) & (h < 18), afternoon)
            .otherwise(night))


def weekday_label(iso_day: Column | str) -> Column:
    """ISO weekday → label: 1 → Seg … 7 → Dom (null is read as 0 ≡ 7)."""
    n = F.coalesce(_c(iso_day).cast("int"), F.lit(0))
    idx = F.pmod(n + 6, F.lit(7)) + 1
    return F.element_at(F.array(*[F.lit(x) for x in WEEKDAY_LABELS]), idx)


def route_key(origin: Column | str, dest: Column | str) -> Column:
    """``origin-dest``; null when either side is null."""
    return F.concat(_c(origin), F.lit("-"), _c(dest))


def route_label(origin: Column | str, dest: Column | str) -> Column:
    return F.concat(_c(origin), F.lit(" ➔ "), _c(dest))
