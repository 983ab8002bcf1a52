"""The full analytic report over a clean flight table."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..codes import DELAY_LIMIT_DEFAULT, ROUTE_MAP_TOP_DEFAULT, SAMPLE_ROWS, TOP_ROUTES
from ..columns import CLEAN_COLUMNS, COLS, FlightColumns, missing_columns
from ..operators.aggregates import (flights_per_day, kpis, sample_rows, status_distribution,
                                    top_routes)
from ..operators.delay import delay_base
from ..operators.filters import FilterSpec, apply_filters, day_condition
from ..sources.sinks import YEAR_PARTITION
from .catalogue import ResultCatalogue
from .insights import delay_insights, route_bundle


# The outputs with rows, but for the filtered flights and the delay base.
REPORT_OUTPUTS = ("kpis", "per_day", "status", "top_routes", "sample", "aeroportos", "variacao", "aumentos", "quedas", "por_ano",
                  "dias_semana", "periodos", "companhias_por_ano", "companhias", "rotas", "nos", "intensidade")


def map_input(base: DataFrame, filtered: DataFrame) -> DataFrame:
    """The delay base when it has rows, else all filtered flights (one cheap job)."""
    return filtered if base.isEmpty() else base


def _narrow(base: DataFrame, cols: FlightColumns) -> DataFrame:
    """The columns of a delay base that the breakdowns and the route map read."""
    used = (cols.airline, cols.origin_name, cols.origin_coords, cols.dest_coords, cols.dep_planned,
            "atraso_min", "ano", "dia_sem", "hora")
    return base.select(*[F.col(f"`{c}`") for c in used if c in base.columns])


def report(clean: DataFrame, spec: FilterSpec | None = None,
           delay_limit: int = DELAY_LIMIT_DEFAULT, coord_fmt: str = "auto",
           map_top: int = ROUTE_MAP_TOP_DEFAULT, with_delay: bool = True,
           cols: FlightColumns = COLS, persist: bool = True,
           store: ResultCatalogue | None = None) -> dict:
    """Filters → overview → delay insights → route map → sample.

    The overview reads the clean table column by column. Only the delay base
    of the filtered flights (late flights, the few columns in use) and the
    routes are persisted (MEMORY_AND_DISK; lost blocks are recomputed from
    lineage). Call ``unpersist_report`` when done. With a ``store`` the delay
    base, the routes and every output are kept there, and a later report
    with the same filters over the same files reads them; nothing is persisted.
    """
    spec = spec or FilterSpec()
    # A clean table written by write_clean carries the year partition column:
    # day ranges then also prune whole years.
    year_col = YEAR_PARTITION if YEAR_PARTITION in clean.columns else None
    filtered = apply_filters(clean, spec, cols, year_col)
    # One base serves both sides of the year-over-year fallback.
    undated = _narrow(delay_base(apply_filters(clean, spec.without_dates(), cols), delay_limit, cols), cols)
    persist = persist and store is None
    keep = DataFrame.persist if persist else (lambda df: df) if store is None else store.result
    if store is not None:
        undated = store.result(undated, "delay_base")
    elif persist:
        undated = undated.persist(StorageLevel.MEMORY_AND_DISK)
    in_range = day_condition(undated, spec, cols)
    base = undated if in_range is None else undated.where(in_range)
    out: dict = {
        "missing_columns": missing_columns(clean, CLEAN_COLUMNS),
        "filtered": filtered,
        "delay_base": base,
        "persisted": [undated] if persist else [],
        "kpis": kpis(filtered, cols),
        "per_day": flights_per_day(filtered, cols),
        "status": status_distribution(filtered, cols),
        "top_routes": top_routes(filtered, TOP_ROUTES, cols),
        "sample": sample_rows(filtered, [cols.dep_planned, cols.flight_number], SAMPLE_ROWS),
    }
    out.update(delay_insights(base, None if in_range is None else undated, in_range, cols))
    out.update(route_bundle(map_input(base, filtered), coord_fmt, map_top, with_delay, cols, keep))
    if persist:
        out["persisted"].append(out["rotas"])
    if store is not None:
        out.update({name: store.result(out[name], name) for name in REPORT_OUTPUTS if name != "rotas"})
    return out


def unpersist_report(out: dict) -> None:
    for df in out.get("persisted", []):
        df.unpersist()
