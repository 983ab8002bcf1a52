"""The report's aggregates kept current from new extracts.

A file stream adds each micro-batch of raw extracts as partial counts and sums,
keyed by day and by what the report groups by; a report over any range of
days adds up these rows and reads no flight again. Rows grow with days times
airports, airlines and routes, not with flights.

Exactly once: a batch is written to a folder named by its batch id, and counts
only with its commit marker. The stream's own log fixes which files a batch id
has, so a batch repeated after a failure writes the same rows over the
same folder. ``compact`` adds the batches up into a base; readers take the
newest base and the batches behind it. One store belongs to one stream, because
batch ids are a stream's own.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from ..codes import (DELAY_LIMIT_DEFAULT, LOCAL_ZONE, ROUTE_MAP_TOP_DEFAULT, TOP_AIRLINES_PER_YEAR, TOP_DELAY_AIRPORTS,
                     TOP_ROUTES)
from ..columns import COLS, FlightColumns
from ..functions.labels import day_period, route_key, route_label, weekday_label
from ..functions.times import delay_minutes, local_day
from ..operators.filters import FilterSpec, day_text
from ..operators.routes import route_intensity, route_nodes, routes_of_texts
from ..operators.yoy import variation_of_counts, yoy_decreases, yoy_increases
from ..plans.transform import transform
from ..session import ensure_checkpoint_dir
from ..sources.files import create_once, delete_folder, is_committed, list_folders, read_text
from .ingest import read_flights_stream

N = "quantidade_atrasos"
KEYS = ("agregado", "dia", "a", "b", "c", "hora")


def partial_aggregates(clean: DataFrame, limit: int = DELAY_LIMIT_DEFAULT, cols: FlightColumns = COLS,
                       zone: str = LOCAL_ZONE) -> DataFrame:
    """``agregado, dia, a, b, c, hora, n, soma``: mergeable counts (and minutes of delay).

    Each flight gives a row per aggregate, combined map-side before the shuffle.
    All flights: ``status`` (a), ``pares`` (airline, origin, destination), ``mapa``
    (coordinates). Late ones, by more than ``limit`` minutes: ``aeroporto``,
    ``empresa``, ``hora``, ``rotas`` (coordinates, minutes)."""
    c = lambda name: F.col(f"`{name}`")
    once = F.inline(F.array(F.struct(local_day(c(cols.dep_planned)).alias("dia"), F.hour(c(cols.dep_planned)).alias("h"),
                                     delay_minutes(c(cols.dep_planned), c(cols.dep_real), zone).alias("min"))))
    used = {"airline": cols.airline, "status": cols.status, "o": cols.origin_icao, "d": cols.dest_icao,
            "name": cols.origin_name, "oc": cols.origin_coords, "dc": cols.dest_coords}
    rows = clean.select(*[c(v).alias(k) for k, v in used.items()], once)
    text, none = F.lit(None).cast("string"), F.lit(None).cast("int")

    def row(name: str, a=text, b=text, d=text, hour=none, minutes=F.lit(0).cast("long")):
        return F.struct(F.lit(name).alias("agregado"), F.col("dia"), a.alias("a"), b.alias("b"), d.alias("c"), hour.alias("hora"),
                        minutes.alias("minutos"))
    x = F.col
    every = F.array(row("status", x("status")), row("pares", x("airline"), x("o"), x("d")), row("mapa", x("oc"), x("dc")))
    late = F.array(row("aeroporto", x("name")), row("empresa", x("airline")), row("hora", hour=x("h")),
                   row("rotas", x("oc"), x("dc"), minutes=x("min").cast("long")))
    parts = F.when(x("min") > limit, F.concat(every, late)).otherwise(every)
    return rows.select(F.inline(parts)).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.sum("minutos").alias("soma"))


def merged(rollups: DataFrame) -> DataFrame:
    return rollups.groupBy(*KEYS).agg(F.sum("n").alias("n"), F.sum("soma").alias("soma"))


def _numbered(spark: SparkSession, root: str, kind: str) -> list[tuple[int, str]]:
    """Committed folders ``<kind>-<number>``."""
    folders = list_folders(spark, f"{root.rstrip('/')}/{kind}")
    return [(int(f.rsplit("-", 1)[1]), f) for f in folders if is_committed(spark, f)]


def _folder(root: str, kind: str, number: int) -> str:
    return f"{root.rstrip('/')}/{kind}/{kind}-{number:012d}"


def _current(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    base = _numbered(spark, root, "base")[-1:]
    return base + [(k, f) for k, f in _numbered(spark, root, "lote") if not base or k > base[0][0]]


def read_rollups(spark: SparkSession, root: str) -> DataFrame:
    """All committed batches, added up."""
    parts = _current(spark, root)
    if not parts:
        raise FileNotFoundError(f"no committed batch under {root}")
    return merged(spark.read.parquet(*[f for _, f in parts]))


def compact(spark: SparkSession, root: str, keep_batches: bool = True) -> int | None:
    """Add the committed batches up into one base; the number of the last one.
    Without ``keep_batches`` the folders behind the new base are removed: not
    while reports that read them still run."""
    parts = _current(spark, root)
    if not parts:
        return None
    last = parts[-1][0]
    if len(parts) > 1 or parts[0][1] != _folder(root, "base", last):
        spark.read.parquet(*[f for _, f in parts]).transform(merged).write.mode("overwrite").parquet(_folder(root, "base", last))
    if not keep_batches:
        for kind in ("lote", "base"):
            for k, folder in _numbered(spark, root, kind):
                if k < last or kind == "lote" and k == last:
                    delete_folder(spark, folder)
    return last


def stream_rollups(spark: SparkSession, source_dir: str, header: Sequence[str], airports: DataFrame, airlines: DataFrame,
                   root: str, checkpoint_path: str | None = None, name: str = "rollups", sep: str = ";",
                   limit: int = DELAY_LIMIT_DEFAULT, files_per_batch: int | None = None, available_now: bool = True,
                   cols: FlightColumns = COLS, zone: str = LOCAL_ZONE,
                   after_write: Callable[[int], None] | None = None) -> StreamingQuery:
    """Start the stream from new extracts in ``source_dir`` to the store ``root``."""
    if checkpoint_path is None:
        checkpoint_path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    owner = f"{root.rstrip('/')}/stream.json"
    create_once(spark, owner, json.dumps({"checkpoint": checkpoint_path, "limit": limit, "zone": zone}))
    held = json.loads(read_text(spark, owner))
    if held != {"checkpoint": checkpoint_path, "limit": limit, "zone": zone}:
        raise ValueError(f"{root} belongs to another stream: {held}")

    def add(batch: DataFrame, number: int) -> None:
        clean = transform(batch, airports, airlines, cols, zone)
        partial_aggregates(clean, limit, cols, zone).write.mode("overwrite").parquet(_folder(root, "lote", number))
        if after_write is not None:
            after_write(number)

    stream = read_flights_stream(spark, source_dir, header, sep, files_per_batch)
    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint_path).queryName(name)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def rollup_report(rollups: DataFrame, spec: FilterSpec | None = None, coord_fmt: str = "auto",
                  map_top: int = ROUTE_MAP_TOP_DEFAULT) -> dict[str, DataFrame]:
    """The outputs of :func:`aerolake.plans.report.report` for a range of days (the
    other filters need flights), but for the sample: equal to those from all
    flights. Persist or store ``rollups`` first; every output reads it."""
    spec = spec or FilterSpec()
    if spec != FilterSpec(day_start=spec.day_start, day_end=spec.day_end):
        raise ValueError("rollups can be filtered by days only")
    days = F.lit(True)
    if spec.day_start is not None:
        days &= F.col("dia") >= F.lit(day_text(spec.day_start)).cast("date")
    if spec.day_end is not None:
        days &= F.col("dia") <= F.lit(day_text(spec.day_end)).cast("date")
    total = F.sum("n").cast("bigint")
    whole = lambda name: rollups.where(F.col("agregado") == name)
    part = lambda name: whole(name).where(days)
    year = F.year("dia").alias("ano")

    pairs = part("pares").groupBy(F.col("a").alias("empresa"), F.col("b").alias("origem"), F.col("c").alias("destino")).agg(total.alias("n"))
    distinct = lambda c: (F.count_distinct(c) + F.coalesce(F.max(c.isNull().cast("int")), F.lit(0))).cast("bigint")
    routes_taken = pairs.groupBy("origem", "destino").agg(total.alias("quantidade"))
    airports = part("aeroporto").groupBy(F.col("a").alias("aeroporto")).agg(total.alias(N))
    inside = F.coalesce(F.sum(F.when(days, F.col("n"))), F.lit(0)).cast("bigint").alias("dentro")
    per_year = whole("aeroporto").groupBy(year, F.col("a").alias("aeroporto")).agg(total.alias("qtd"), inside)
    variation = variation_of_counts(per_year)
    weekdays = part("aeroporto").groupBy(year, (F.weekday("dia") + 1).alias("dia_sem")).agg(total.alias(N))
    periods = part("hora").groupBy(year, day_period("hora").alias("periodo")).agg(total.alias(N))
    by_airline = part("empresa").groupBy(year, F.col("a").alias("empresa")).agg(total.alias(N))
    rank = F.dense_rank().over(Window.partitionBy("ano").orderBy(F.desc(N)))
    ends = [F.col("a").alias("__oc"), F.col("b").alias("__dc")]
    late = part("rotas")
    if late.isEmpty():
        texts = part("mapa").groupBy(*ends).agg(F.sum("n").alias("__n"))
    else:
        texts = late.groupBy(*ends).agg(F.sum("n").alias("__n"), F.sum("soma").alias("__s"), F.sum("n").alias("__c"))
    routes = routes_of_texts(texts, coord_fmt, map_top)
    return {
        "kpis": pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("voos"), distinct(F.col("empresa")).alias("empresas"),
                          distinct(route_key(F.col("origem"), F.col("destino"))).alias("rotas")),
        "per_day": part("status").groupBy("dia").agg(total.alias("voos")).orderBy("dia"),
        "status": part("status").groupBy(F.col("a").alias("status")).agg(total.alias("quantidade"))
                                .orderBy(F.desc("quantidade"), F.asc("status")),
        "top_routes": routes_taken.orderBy(F.desc("quantidade"), F.asc("origem"), F.asc("destino")).limit(TOP_ROUTES)
                                  .withColumn("rota", route_label("origem", "destino")),
        "aeroportos": airports.orderBy(F.desc(N), F.asc("aeroporto")).limit(TOP_DELAY_AIRPORTS),
        "variacao": variation, "aumentos": yoy_increases(variation), "quedas": yoy_decreases(variation),
        "por_ano": part("aeroporto").groupBy(year).agg(total.alias(N)).orderBy("ano"),
        "dias_semana": weekdays.withColumn("dia", weekday_label("dia_sem")).orderBy(F.asc("ano"), F.desc(N), F.asc("dia_sem")),
        "periodos": periods.orderBy(F.asc("ano"), F.desc(N), F.asc("periodo")),
        "companhias_por_ano": by_airline.orderBy(F.asc("ano"), F.desc(N), F.asc("empresa")),
        "companhias": by_airline.withColumn("__rk", rank).where(F.col("__rk") <= TOP_AIRLINES_PER_YEAR).drop("__rk")
                                .orderBy(F.asc("ano"), F.desc(N), F.asc("empresa")),
        "rotas": routes, "nos": route_nodes(routes), "intensidade": route_intensity(routes),
    }
