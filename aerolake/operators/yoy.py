"""Year-over-year change of delays per airport between the two latest years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..codes import YOY_TOP
from ..columns import COLS, FlightColumns
from .aggregates import empty_result


FIELDS = [("aeroporto", "string"), ("y_prev", "bigint"), ("y_curr", "bigint"),
          ("ano_prev", "int"), ("ano_curr", "int"), ("delta", "bigint")]


def delays_per_year_airport(base: DataFrame, cols: FlightColumns = COLS, *more: Column) -> DataFrame:
    """Delays per year and origin airport; combined map-side."""
    return (base.groupBy(F.col("ano").cast("int").alias("ano"),
                         F.col(f"`{cols.origin_name}`").alias("aeroporto"))
                .agg(F.count(F.lit(1)).alias("qtd"), *more))


def _variation(per_year: DataFrame) -> DataFrame:
    """Change between the two latest years of each ``variante`` (columns
    ``variante, ano, aeroporto, qtd``), nothing for a variant with fewer.

    The base is read once: years are ranked on the aggregated rows, and
    ``WindowGroupLimit`` keeps each task's two latest years before the shuffle.
    """
    latest = Window.partitionBy("variante").orderBy(F.desc("ano"))
    whole = Window.partitionBy("variante")
    two = (per_year.where(F.col("ano").isNotNull()).withColumn("__rk", F.dense_rank().over(latest)).where("__rk <= 2")
           .withColumns({"ano_prev": F.min("ano").over(whole), "ano_curr": F.max("ano").over(whole)})
           .where("ano_prev < ano_curr"))
    year = lambda slot: F.sum(F.when(F.col("ano") == F.col(slot), F.col("qtd")).otherwise(0)).cast("bigint")
    return (two.groupBy("variante", "aeroporto", "ano_prev", "ano_curr")
               .agg(year("ano_prev").alias("y_prev"), year("ano_curr").alias("y_curr"))
               .withColumn("delta", F.col("y_curr") - F.col("y_prev")))


def yoy_variation(base: DataFrame, cols: FlightColumns = COLS) -> DataFrame:
    """Per airport: delays in the previous and current year (0 when absent) and
    ``delta = y_curr − y_prev``; also the two years compared."""
    if "ano" not in base.columns or cols.origin_name not in base.columns:
        return empty_result(base, FIELDS)
    per_year = delays_per_year_airport(base, cols).withColumn("variante", F.lit(0))
    return _variation(per_year).select(*[n for n, _ in FIELDS])


def yoy_variation_with_fallback(base: DataFrame, in_range: Column | None, cols: FlightColumns = COLS) -> DataFrame:
    """Year-over-year on the flights within the day range; if these span fewer
    than two years, on all of ``base`` (every filter except the day range).
    Adds ``usou_fallback``.

    One pass: both variants are counted side by side, and the one to use is
    chosen on the aggregated rows.
    """
    if "ano" not in base.columns or cols.origin_name not in base.columns:
        return empty_result(base, [*FIELDS, ("usou_fallback", "boolean")])
    if in_range is None:
        return yoy_variation(base, cols).withColumn("usou_fallback", F.lit(False))
    inside = F.count(F.when(in_range, F.lit(1))).alias("dentro")
    return variation_of_counts(delays_per_year_airport(base, cols, inside))


def variation_of_counts(per_year: DataFrame) -> DataFrame:
    """The change from ``ano, aeroporto, qtd`` (all delays) and ``dentro`` (those in
    the day range), with the fallback."""
    both = F.inline(F.array(F.struct(F.lit(0).alias("variante"), F.col("dentro").alias("qtd")),
                            F.struct(F.lit(1).alias("variante"), F.col("qtd").alias("qtd"))))
    per_year = per_year.select("ano", "aeroporto", both).where("qtd > 0")
    chosen = F.min("variante").over(Window.partitionBy())
    out = _variation(per_year).withColumn("__first", chosen).where("variante = __first")
    return out.select(*[n for n, _ in FIELDS], (F.col("variante") == 1).alias("usou_fallback"))


def yoy_increases(variation: DataFrame, n: int = YOY_TOP) -> DataFrame:
    return variation.orderBy(F.desc("delta"), F.asc("aeroporto")).limit(n)


def yoy_decreases(variation: DataFrame, n: int = YOY_TOP) -> DataFrame:
    return variation.orderBy(F.asc("delta"), F.asc("aeroporto")).limit(n)
