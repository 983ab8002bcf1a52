"""User filter specification → one predicate pushed down by Catalyst."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..columns import COLS, FlightColumns, column_type, is_temporal
from ..lineage import is_stored


@dataclass(frozen=True)
class FilterSpec:
    """AND of optional IN-lists and an inclusive day range; empty = no filter.

    Airport codes and airport names are separate lists (filtering ICAO codes
    with names would never match).
    """
    airlines: tuple = ()
    situations: tuple = ()
    statuses: tuple = ()
    line_types: tuple = ()
    origin_icao: tuple = ()
    dest_icao: tuple = ()
    origin_names: tuple = ()
    dest_names: tuple = ()
    day_start: str | dt.date | None = None
    day_end: str | dt.date | None = None

    def without_dates(self) -> "FilterSpec":
        return replace(self, day_start=None, day_end=None)

    @property
    def has_dates(self) -> bool:
        return self.day_start is not None or self.day_end is not None


def day_text(d: str | dt.date) -> str:
    """``YYYY-MM-DD`` of a date, a datetime or a text that starts with a whole date."""
    if isinstance(d, dt.date):
        return d.strftime("%Y-%m-%d")
    day = dt.date.fromisoformat(str(d)[:10])
    if len(str(d)) > 10:
        dt.datetime.fromisoformat(str(d))
    return day.strftime("%Y-%m-%d")


def day_condition(df: DataFrame, spec: FilterSpec, cols: FlightColumns = COLS,
                  year_col: str | None = None) -> Column | None:
    """The inclusive day range alone; None without one."""
    if not spec.has_dates or cols.dep_planned not in df.columns:
        return None
    c = F.col(f"`{cols.dep_planned}`")
    if is_temporal(column_type(df, cols.dep_planned)):
        day = F.to_date(c)
        bound = lambda d: F.lit(day_text(d)).cast("date")
    else:
        # Textual times: compare the YYYY-MM-DD prefix so the end day is kept whole.
        day = F.substring(c, 1, 10)
        bound = lambda d: F.lit(day_text(d))
    conds = []
    if spec.day_start is not None:
        conds.append(day >= bound(spec.day_start))
    if spec.day_end is not None:
        conds.append(day <= bound(spec.day_end))
    # Extra predicate on a year partition column → partition pruning.
    if year_col and year_col in df.columns:
        if spec.day_start is not None:
            conds.append(F.col(year_col) >= int(day_text(spec.day_start)[:4]))
        if spec.day_end is not None:
            conds.append(F.col(year_col) <= int(day_text(spec.day_end)[:4]))
    return reduce(and_, conds)


def filter_condition(df: DataFrame, spec: FilterSpec, cols: FlightColumns = COLS,
                     year_col: str | None = None) -> Column | None:
    conds: list[Column] = []
    lists = ((cols.airline, spec.airlines), (cols.situation, spec.situations),
             (cols.status, spec.statuses), (cols.line_type, spec.line_types),
             (cols.origin_icao, spec.origin_icao), (cols.dest_icao, spec.dest_icao),
             (cols.origin_name, spec.origin_names), (cols.dest_name, spec.dest_names))
    for name, values in lists:
        if values:
            conds.append(F.col(f"`{name}`").isin(list(values)))

    days = day_condition(df, spec, cols, year_col)
    if days is not None:
        conds.append(days)

    return reduce(and_, conds) if conds else None


def _computed_once(df: DataFrame, spec: FilterSpec, cols: FlightColumns) -> DataFrame:
    """``df`` with the planned departure and the status, if the filter reads them and
    they are computed from other columns, passed through a one-row generator:
    Catalyst pushes no condition below it, where it would repeat the formatting and
    parsing of times in the joins. Stored columns stay open to the scan."""
    read = [c for c, wanted in ((cols.dep_planned, spec.has_dates), (cols.status, spec.statuses)) if wanted and c in df.columns]
    pinned = [c for c in read if not is_stored(df, c)]
    if not pinned or df.isStreaming:
        return df
    once = F.inline(F.array(F.struct(*[F.col(f"`{c}`").alias(c) for c in pinned])))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in pinned], once).select(*[F.col(f"`{c}`") for c in df.columns])


def apply_filters(df: DataFrame, spec: FilterSpec | None, cols: FlightColumns = COLS,
                  year_col: str | None = None) -> DataFrame:
    if spec is None:
        return df
    df = _computed_once(df, spec, cols)
    cond = filter_condition(df, spec, cols, year_col)
    return df if cond is None else df.filter(cond)
