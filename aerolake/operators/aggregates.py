"""Overview aggregations of a (filtered) flight table.

Each function is lazy: group-bys use partial (map-side) aggregation, so even
a hub holding a third of all flights is combined per task before the
shuffle; top-k uses ``orderBy().limit()`` (TakeOrderedAndProject) with the
group keys as tie-breakers so results are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..codes import SAMPLE_ROWS, TOP_ROUTES
from ..columns import COLS, FlightColumns, column_type, is_temporal
from ..functions.labels import route_key, route_label
from ..functions.times import local_day, text_day


def _col(name: str):
    return F.col(f"`{name}`")


def empty_result(df: DataFrame, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """The typed empty answer for an input that lacks the needed columns
    (derived from ``df`` itself, so it stays lazy and costs nothing)."""
    return df.limit(0).select(*[F.lit(None).cast(t).alias(n) for n, t in fields])


def flights_per_day(df: DataFrame, cols: FlightColumns = COLS, column: str | None = None) -> DataFrame:
    """Flights per local day of the planned departure, day ascending.

    A timestamp column gives ``(dia DATE, voos)``; a text column falls back to
    its first 10 characters, ``(dia_str, voos)``.
    """
    column = column or cols.dep_planned
    if column not in df.columns:
        return empty_result(df, [("dia", "date"), ("voos", "bigint")])
    if is_temporal(column_type(df, column)):
        key = local_day(_col(column)).alias("dia")
    else:
        key = text_day(_col(column)).alias("dia_str")
    out = df.groupBy(key).agg(F.count(F.lit(1)).alias("voos"))
    return out.orderBy(out.columns[0])


def status_distribution(df: DataFrame, cols: FlightColumns = COLS) -> DataFrame:
    """Count per late status (or per flight situation if the status is absent)."""
    col = cols.status if cols.status in df.columns else cols.situation
    if col not in df.columns:
        return empty_result(df, [("status", "string"), ("quantidade", "bigint")])
    out = df.groupBy(_col(col).alias("status")).agg(F.count(F.lit(1)).alias("quantidade"))
    return out.orderBy(F.desc("quantidade"), F.asc("status"))


def top_routes(df: DataFrame, n: int = TOP_ROUTES, cols: FlightColumns = COLS) -> DataFrame:
    """The ``n`` (origin, destination) pairs with most flights."""
    if cols.origin_icao not in df.columns or cols.dest_icao not in df.columns:
        return empty_result(df, [("origem", "string"), ("destino", "string"),
                                 ("quantidade", "bigint"), ("rota", "string")])
    out = (df.groupBy(_col(cols.origin_icao).alias("origem"), _col(cols.dest_icao).alias("destino"))
             .agg(F.count(F.lit(1)).alias("quantidade")))
    out = out.orderBy(F.desc("quantidade"), F.asc("origem"), F.asc("destino")).limit(n)
    return out.withColumn("rota", route_label("origem", "destino"))


def _distinct_with_null(c) -> F.Column:
    """Distinct values counting null as one value."""
    return (F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))).cast("bigint")


def kpis(df: DataFrame, cols: FlightColumns = COLS) -> DataFrame:
    """One row: flights, distinct airlines, distinct routes (0 when a column is absent).

    Flights are first counted per airline and route, combined map-side; the
    distinct counts then run over these few rows.
    """
    keys = {}
    if cols.airline in df.columns:
        keys["empresa"] = _col(cols.airline)
    if cols.origin_icao in df.columns and cols.dest_icao in df.columns:
        keys.update(origem=_col(cols.origin_icao), destino=_col(cols.dest_icao))
    if not keys:
        return df.agg(F.count(F.lit(1)).cast("bigint").alias("voos"), F.lit(0).cast("bigint").alias("empresas"),
                      F.lit(0).cast("bigint").alias("rotas"))
    per = df.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    return per.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("voos"),
        (_distinct_with_null(F.col("empresa")) if "empresa" in keys else zero).alias("empresas"),
        (_distinct_with_null(route_key(F.col("origem"), F.col("destino"))) if "origem" in keys else zero).alias("rotas"))


def unique_values(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Sorted non-null distinct values of ``column``: all, or the first ``limit``
    (the original's selection lists stop at ``UNIQUE_VALUES_LIMIT``)."""
    if column not in df.columns:
        return empty_result(df, [("valor", "string")])
    out = df.select(_col(column).alias("valor")).where(F.col("valor").isNotNull()).distinct().orderBy("valor")
    return out if limit is None else out.limit(limit)


def filter_options(df: DataFrame, columns: Sequence[str], limit: int | None = None) -> DataFrame:
    """The distinct-value lists of several filter columns, as rows
    ``(coluna, valor)``: non-null values as text, all or the first ``limit`` of
    each column.

    One scan: every row gives its (column, value) pairs, which are made
    distinct map-side before the one shuffle. A limit ranks the distinct
    values of each column, cut per task first (``WindowGroupLimit``).
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("coluna"), _col(c).cast("string").alias("valor")) for c in columns]))
    out = df.select(pairs).where(F.col("valor").isNotNull()).distinct()
    if limit is None:
        return out
    rank = F.row_number().over(Window.partitionBy("coluna").orderBy("valor"))
    return out.withColumn("__rk", rank).where(F.col("__rk") <= limit).drop("__rk")


def date_bounds(df: DataFrame, column: str) -> DataFrame:
    """One row ``(inicio, fim)``: min and max of a date/timestamp column,
    nulls ignored; nulls when the column is absent or not temporal."""
    dtype = column_type(df, column)
    if not is_temporal(dtype):
        null = F.lit(None).cast(T.TimestampNTZType())
        return df.agg(F.count(F.lit(1))).select(null.alias("inicio"), null.alias("fim"))
    c = _col(column)
    return df.agg(F.min(c).alias("inicio"), F.max(c).alias("fim"))


def sample_rows(df: DataFrame, order_by: Sequence[str], n: int = SAMPLE_ROWS) -> DataFrame:
    """First ``n`` rows in a stated order (top-k, not a full sort)."""
    return df.orderBy(*[_col(c) for c in order_by]).limit(n)
