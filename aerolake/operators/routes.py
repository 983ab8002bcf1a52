"""Geographic route and node aggregation for the route map.

Coordinates are text attributes of the airports, so a flight table repeats
the same few thousand strings. The route aggregation therefore groups by the
two raw coordinate strings first (partial aggregation shrinks the data
map-side), parses only the distinct strings, and then regroups by the
parsed coordinates. Counts and sums are exact under the regroup; the mean is
carried as (sum, count).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..codes import QUANTILE_HIGH, QUANTILE_LOW, ROUTE_MAP_TOP_DEFAULT, SCALE_RANGE_FLOOR
from ..columns import COLS, FlightColumns
from ..functions.geo import in_box, with_lon_lat
from .aggregates import empty_result
from .quantiles import exact_quantiles

ROUTE_KEYS = ["origem_lon", "origem_lat", "destino_lon", "destino_lat"]


def route_map(df: DataFrame, fmt: str = "auto", top: int | None = ROUTE_MAP_TOP_DEFAULT,
              with_delay: bool = True, cols: FlightColumns = COLS) -> DataFrame:
    """The ``top`` routes (None: all) by flight count between valid coordinates,
    with the mean delay when asked for and available."""
    if top is not None and int(top) < 1:
        raise ValueError(f"route budget {top} is not positive")
    use_delay = with_delay and "atraso_min" in df.columns
    if cols.origin_coords not in df.columns or cols.dest_coords not in df.columns:
        fields = [(k, "double") for k in ROUTE_KEYS] + [("quantidade", "bigint")]
        return empty_result(df, fields + ([("atraso_medio", "double")] if use_delay else []))
    oc, dc = F.col(f"`{cols.origin_coords}`"), F.col(f"`{cols.dest_coords}`")
    use_delay = with_delay and "atraso_min" in df.columns
    aggs = [F.count(F.lit(1)).alias("__n")]
    if use_delay:
        aggs += [F.sum("atraso_min").alias("__s"), F.count("atraso_min").alias("__c")]
    return routes_of_texts(df.groupBy(oc.alias("__oc"), dc.alias("__dc")).agg(*aggs), fmt, top)


def routes_of_texts(by_text: DataFrame, fmt: str = "auto", top: int | None = ROUTE_MAP_TOP_DEFAULT) -> DataFrame:
    """Routes from flights counted per pair of coordinate texts: ``__oc, __dc, __n``
    and, for mean delays, their sum ``__s`` and number ``__c``."""
    parsed = with_lon_lat(by_text, F.col("__oc"), "origem_lon", "origem_lat", fmt)
    parsed = with_lon_lat(parsed, F.col("__dc"), "destino_lon", "destino_lat", fmt)
    valid = (in_box(F.col("origem_lon"), F.col("origem_lat"))
             & in_box(F.col("destino_lon"), F.col("destino_lat")))

    # Validity is a function of the route keys, so it is carried as an
    # aggregate (max) and applied after the regroup: a predicate on the keys
    # would be pushed below the first group-by and re-parse every flight row.
    raggs = [F.sum("__n").cast("bigint").alias("quantidade"),
             F.max(F.coalesce(valid, F.lit(False))).alias("__ok")]
    if "__s" in by_text.columns:
        raggs.append((F.sum("__s") / F.sum("__c")).alias("atraso_medio"))
    routes = parsed.groupBy(*ROUTE_KEYS).agg(*raggs).filter(F.col("__ok")).drop("__ok")
    return routes if top is None else routes.orderBy(F.desc("quantidade"), *[F.asc(c) for c in ROUTE_KEYS]).limit(top)


def route_nodes(routes: DataFrame) -> DataFrame:
    """Endpoints of the given routes with the summed route counts.

    Each route row is read once and emits its two endpoints (no re-scan).
    """
    ends = F.array(
        F.struct(F.col("origem_lon").alias("lon"), F.col("origem_lat").alias("lat"),
                 F.col("quantidade").alias("q")),
        F.struct(F.col("destino_lon").alias("lon"), F.col("destino_lat").alias("lat"),
                 F.col("quantidade").alias("q")))
    return (routes.select(F.inline(ends))
                  .groupBy("lon", "lat").agg(F.sum("q").cast("bigint").alias("quantidade")))


def route_intensity(routes: DataFrame, metric: str | None = None, unlimited: bool = False) -> DataFrame:
    """Robust 0-1 scaling of a route metric: ``(x − p05) / max(p95 − p05, 1e-6)``
    clipped to [0, 1]; the metric is the mean delay if present, else the count.

    The percentiles are a one-row aggregate that every row reads as a scalar;
    persist or write ``routes`` first if computing them is dear, they are read twice.
    That aggregate keeps all values in one task: for routes without a limit,
    ``unlimited`` finds the same two values by ranks, in a few jobs at once.
    """
    if metric is None:
        metric = "atraso_medio" if "atraso_medio" in routes.columns else "quantidade"
    x = F.col(metric).cast("double")
    if unlimited:
        lo, hi = (F.lit(v).cast("double") for v in exact_quantiles(routes, metric, (QUANTILE_LOW, QUANTILE_HIGH)))
    else:
        bounds = routes.agg(F.struct(F.percentile(x, F.lit(QUANTILE_LOW)).alias("lo"),
                                     F.percentile(x, F.lit(QUANTILE_HIGH)).alias("hi"))).scalar()
        lo, hi = bounds.getField("lo"), bounds.getField("hi")
    scaled = (x - lo) / F.greatest(hi - lo, F.lit(SCALE_RANGE_FLOOR))
    return routes.withColumn("intensidade", F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0)))
