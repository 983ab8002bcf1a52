"""Command-line jobs (``python -m aerolake …`` or ``spark-submit -m``).

``build``  raw CSV extracts / raw Parquet + lookups → clean Parquet table.
``report`` clean table + filters → every report DataFrame written as Parquet.
``run``    reuse the clean table when present (else build it), then report.
``update`` new CSV extracts → aggregates kept current, and the report of a range of
           days from them, without reading earlier flights again.

``report`` and ``run`` take ``--store``: a folder of results that later jobs reuse.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from .codes import DELAY_LIMIT_DEFAULT, ROUTE_MAP_TOP_DEFAULT
from .columns import AIRLINE_FIELDS, AIRPORT_FIELDS
from .operators.filters import FilterSpec
from .plans.catalogue import ResultCatalogue
from .plans.report import report, unpersist_report
from .plans.transform import load_or_build, run_batch
from .session import BASE_CONF
from .sources.csv import split_header
from .sources.files import expand_glob, first_lines
from .sources.lookups import read_lookup_records
from .streaming.rollup import compact, read_rollups, rollup_report, stream_rollups


def _session() -> SparkSession:
    builder = SparkSession.builder.appName("aerolake")
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def _split(values: str | None) -> tuple:
    return tuple(v for v in (values or "").split(",") if v)


def spec_from_args(a: argparse.Namespace) -> FilterSpec:
    return FilterSpec(airlines=_split(a.airline_names), situations=_split(a.situations),
                      statuses=_split(a.statuses), line_types=_split(a.line_types),
                      origin_icao=_split(a.origin_icao), dest_icao=_split(a.dest_icao),
                      origin_names=_split(a.origin_names), dest_names=_split(a.dest_names),
                      day_start=a.day_start, day_end=a.day_end)


def write_report(out: dict, out_dir: str) -> list[str]:
    """Write each DataFrame of a report bundle to ``out_dir/<name>``, and the
    expected columns missing from the input to ``missing_columns.json``."""
    import json

    from .sources.files import write_bytes
    written = []
    for name, df in out.items():
        if isinstance(df, DataFrame) and name not in ("filtered", "delay_base"):
            df.write.mode("overwrite").parquet(os.path.join(out_dir, name))
            written.append(name)
    spark = SparkSession.getActiveSession()
    missing = json.dumps(out.get("missing_columns", []), ensure_ascii=False).encode("utf-8")
    write_bytes(spark, os.path.join(out_dir, "missing_columns.json"), missing)
    return written


def _build(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return run_batch(spark, out_path=a.clean, airports_path=a.airports, airlines_path=a.airlines,
                     raw_parquet=a.raw_parquet, csv_glob=a.csv, airports_fmt=a.airports_fmt)


def _report(spark: SparkSession, clean: DataFrame, a: argparse.Namespace) -> list[str]:
    store = ResultCatalogue(spark, a.store) if a.store else None
    out = report(clean, spec_from_args(a), a.delay_limit, a.coord_format, a.map_top, store=store)
    try:
        return write_report(out, a.out)
    finally:
        unpersist_report(out)


def _update(spark: SparkSession, a: argparse.Namespace) -> list[str]:
    files = expand_glob(spark, f"{a.csv_folder.rstrip('/')}/[!_.]*")
    if not files:
        raise FileNotFoundError(f"no CSV file in {a.csv_folder!r}")
    header = split_header(first_lines(spark, files[:1])[0], ";")
    query = stream_rollups(spark, a.csv_folder, header, read_lookup_records(spark, a.airports, AIRPORT_FIELDS, a.airports_fmt),
                           read_lookup_records(spark, a.airlines, AIRLINE_FIELDS, "array"), a.rollups, f"{a.rollups.rstrip('/')}/log",
                           limit=a.delay_limit)
    query.awaitTermination()
    compact(spark, a.rollups)
    rollups = read_rollups(spark, a.rollups).persist()
    try:
        days = FilterSpec(day_start=a.day_start, day_end=a.day_end)
        return write_report(rollup_report(rollups, days, a.coord_format, a.map_top), a.out)
    finally:
        rollups.unpersist()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="aerolake")
    sub = p.add_subparsers(dest="cmd", required=True)

    def build_args(sp):
        sp.add_argument("--clean", required=True, help="clean table path (output of build)")
        sp.add_argument("--csv", help="glob of raw CSV extracts")
        sp.add_argument("--raw-parquet", help="raw Parquet used instead of the CSVs when present")
        sp.add_argument("--airports", help="airport records (JSON)")
        sp.add_argument("--airports-fmt", default="array", choices=("array", "ndjson"))
        sp.add_argument("--airlines", help="airline records (JSON array)")

    def output_args(sp):
        sp.add_argument("--out", required=True, help="folder for the report tables")
        sp.add_argument("--delay-limit", type=int, default=DELAY_LIMIT_DEFAULT)
        sp.add_argument("--coord-format", default="auto", choices=("auto", "lon,lat", "lat,lon"))
        sp.add_argument("--map-top", type=int, default=ROUTE_MAP_TOP_DEFAULT)
        sp.add_argument("--day-start")
        sp.add_argument("--day-end")

    def report_args(sp):
        output_args(sp)
        sp.add_argument("--store", help="folder of results to reuse and add to")
        for name in ("airline-names", "situations", "statuses", "line-types", "origin-icao",
                     "dest-icao", "origin-names", "dest-names"):
            sp.add_argument(f"--{name}", help="comma-separated values")

    build_args(sub.add_parser("build", help="raw flights → clean table"))
    rp = sub.add_parser("report", help="clean table → report tables")
    rp.add_argument("--clean", required=True)
    report_args(rp)
    run = sub.add_parser("run", help="reuse or build the clean table, then report")
    build_args(run)
    run.add_argument("--rebuild", action="store_true")
    report_args(run)
    update = sub.add_parser("update", help="new extracts → aggregates kept current, then report")
    update.add_argument("--csv-folder", required=True, help="folder to which extracts with one header are added")
    update.add_argument("--rollups", required=True, help="folder of the aggregates")
    update.add_argument("--airports", required=True, help="airport records (JSON)")
    update.add_argument("--airports-fmt", default="array", choices=("array", "ndjson"))
    update.add_argument("--airlines", required=True, help="airline records (JSON array)")
    output_args(update)
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    spark = spark or _session()
    if a.cmd == "build":
        _build(spark, a)
    elif a.cmd == "report":
        _report(spark, spark.read.parquet(a.clean), a)
    elif a.cmd == "update":
        _update(spark, a)
    else:
        clean = load_or_build(spark, a.clean, lambda: _build(spark, a), rebuild=a.rebuild)
        _report(spark, clean, a)
    return 0
