"""Delay base (flights departing more than a threshold late) and its breakdowns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..codes import DELAY_LIMIT_DEFAULT, LOCAL_ZONE, TOP_AIRLINES_PER_YEAR
from ..columns import COLS, FlightColumns
from ..functions.labels import day_period, weekday_label
from ..functions.times import calendar_parts, delay_minutes
from .aggregates import empty_result

N = "quantidade_atrasos"


def _col(name: str):
    return F.col(f"`{name}`")


def delay_base(df: DataFrame, limit: int = DELAY_LIMIT_DEFAULT, cols: FlightColumns = COLS,
               zone: str = LOCAL_ZONE) -> DataFrame:
    """Add ``atraso_min`` (real − planned departure, whole minutes),
    ``ano``/``dia_sem``/``hora`` of the planned departure, and keep rows with
    ``atraso_min > limit`` (strict).

    The delay passes through a generator (``inline`` of one row): Catalyst does
    not push the filter below it, where it would repeat the parsing of the
    times for every flight of a lazily cleaned table, before the joins.
    """
    if cols.dep_planned not in df.columns or cols.dep_real not in df.columns:
        # No departure times: no delayed flight (typed, empty, still lazy).
        return df.limit(0).withColumns({"atraso_min": F.lit(None).cast("bigint"),
                                        "ano": F.lit(None).cast("int"),
                                        "dia_sem": F.lit(None).cast("int"),
                                        "hora": F.lit(None).cast("int")})
    parts = calendar_parts(_col(cols.dep_planned))
    delay = delay_minutes(_col(cols.dep_planned), _col(cols.dep_real), zone)
    once = F.inline(F.array(F.struct(delay.alias("atraso_min"), *[c.alias(n) for n, c in parts.items()])))
    out = df.select(*[_col(c) for c in df.columns if c not in ("atraso_min", *parts)], once)
    return out.filter(F.col("atraso_min").isNotNull() & (F.col("atraso_min") > F.lit(limit)))


def _count() -> F.Column:
    return F.count(F.lit(1)).alias(N)


def _lacks(base: DataFrame, *names: str) -> bool:
    return any(n not in base.columns for n in names)


def delay_by_airport(base: DataFrame, top: int | None = None, cols: FlightColumns = COLS) -> DataFrame:
    """Delayed departures per origin airport, most first."""
    if _lacks(base, cols.origin_name):
        return empty_result(base, [("aeroporto", "string"), (N, "bigint")])
    out = base.groupBy(_col(cols.origin_name).alias("aeroporto")).agg(_count())
    out = out.orderBy(F.desc(N), F.asc("aeroporto"))
    return out.limit(top) if top else out


def delay_by_year(base: DataFrame) -> DataFrame:
    if _lacks(base, "ano"):
        return empty_result(base, [("ano", "int"), (N, "bigint")])
    return base.groupBy("ano").agg(_count()).orderBy("ano")


def delay_by_weekday(base: DataFrame) -> DataFrame:
    """Per year and ISO weekday, with the weekday label (1 → Seg … 7 → Dom)."""
    if _lacks(base, "ano", "dia_sem"):
        return empty_result(base, [("ano", "int"), ("dia_sem", "int"), (N, "bigint"), ("dia", "string")])
    out = base.groupBy("ano", "dia_sem").agg(_count())
    out = out.withColumn("dia", weekday_label("dia_sem"))
    return out.orderBy(F.asc("ano"), F.desc(N), F.asc("dia_sem"))


def delay_by_period(base: DataFrame) -> DataFrame:
    if _lacks(base, "ano", "hora"):
        return empty_result(base, [("ano", "int"), ("periodo", "string"), (N, "bigint")])
    out = base.groupBy("ano", day_period("hora").alias("periodo")).agg(_count())
    return out.orderBy(F.asc("ano"), F.desc(N), F.asc("periodo"))


def delay_by_airline(base: DataFrame, cols: FlightColumns = COLS) -> DataFrame:
    if _lacks(base, "ano", cols.airline):
        return empty_result(base, [("ano", "int"), ("empresa", "string"), (N, "bigint")])
    out = base.groupBy("ano", _col(cols.airline).alias("empresa")).agg(_count())
    return out.orderBy(F.asc("ano"), F.desc(N), F.asc("empresa"))


def top_airlines_per_year(base: DataFrame, n: int = TOP_AIRLINES_PER_YEAR,
                          cols: FlightColumns = COLS) -> DataFrame:
    """Airlines whose delay count has dense rank ≤ ``n`` within the year (ties kept).

    Ranks the already aggregated (year, airline) counts; Spark adds a
    partial ``WindowGroupLimit`` before the shuffle by year.
    """
    if _lacks(base, "ano", cols.airline):
        return empty_result(base, [("ano", "int"), ("empresa", "string"), (N, "bigint")])
    per = base.groupBy("ano", _col(cols.airline).alias("empresa")).agg(_count())
    w = Window.partitionBy("ano").orderBy(F.desc(N))
    out = per.withColumn("__rk", F.dense_rank().over(w)).filter(F.col("__rk") <= n).drop("__rk")
    return out.orderBy(F.asc("ano"), F.desc(N), F.asc("empresa"))
