"""Delay insights and route-map bundles over a delay base."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from ..codes import ROUTE_MAP_TOP_DEFAULT, TOP_AIRLINES_PER_YEAR, TOP_DELAY_AIRPORTS
from ..columns import COLS, FlightColumns
from ..operators.delay import (delay_by_airline, delay_by_airport, delay_by_period,
                               delay_by_weekday, delay_by_year, top_airlines_per_year)
from ..operators.routes import route_intensity, route_map, route_nodes
from ..operators.yoy import yoy_decreases, yoy_increases, yoy_variation_with_fallback


def delay_insights(base: DataFrame, base_without_dates: DataFrame | None = None, in_range: Column | None = None,
                   cols: FlightColumns = COLS) -> dict[str, DataFrame]:
    """Every delay breakdown of one base. With a day range, ``base_without_dates``
    and the range as ``in_range`` serve the year-over-year fallback."""
    src = base if base_without_dates is None else base_without_dates
    variation = yoy_variation_with_fallback(src, None if base_without_dates is None else in_range, cols)
    return {
        "aeroportos": delay_by_airport(base, TOP_DELAY_AIRPORTS, cols),
        "variacao": variation,
        "aumentos": yoy_increases(variation),
        "quedas": yoy_decreases(variation),
        "por_ano": delay_by_year(base),
        "dias_semana": delay_by_weekday(base),
        "periodos": delay_by_period(base),
        "companhias_por_ano": delay_by_airline(base, cols),
        "companhias": top_airlines_per_year(base, TOP_AIRLINES_PER_YEAR, cols),
    }


def route_bundle(df: DataFrame, fmt: str = "auto", top: int | None = ROUTE_MAP_TOP_DEFAULT,
                 with_delay: bool = True, cols: FlightColumns = COLS,
                 keep: Callable[[DataFrame], DataFrame] = DataFrame.persist) -> dict[str, DataFrame]:
    """Routes, their nodes and intensities. ``keep`` holds on to the routes (few,
    already aggregated), so that the three outputs compute them once: persisted
    by default (unpersist them when done), or stored."""
    routes = keep(route_map(df, fmt, top, with_delay, cols))
    return {"rotas": routes, "nos": route_nodes(routes), "intensidade": route_intensity(routes, unlimited=top is None)}
