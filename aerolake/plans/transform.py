"""Cleaning pipeline (raw flights → clean flights) and the batch job around it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..codes import LOCAL_ZONE
from ..columns import AIRLINE_FIELDS, AIRPORT_FIELDS, COLS, FlightColumns
from ..operators.clean import drop_unused, late_flag, localise, remove_invalid_flights
from ..operators.enrich import decode_codes, enrich_airline, enrich_airports
from ..sources.csv import read_flights_csv
from ..sources.files import is_committed
from ..sources.lookups import read_lookup_records
from ..sources.sinks import write_clean


def map_rows(flights: DataFrame, airports: DataFrame, airlines: DataFrame,
             cols: FlightColumns = COLS, dedupe_lookups: bool = True,
             broadcast: tuple = (None, None)) -> DataFrame:
    """Airport enrich (+ known/non-heliport endpoints, size decode), code
    decodes, airline enrich."""
    return (flights
            .transform(lambda d: enrich_airports(d, airports, cols, broadcast=broadcast[0], dedupe=dedupe_lookups))
            .transform(lambda d: decode_codes(d, cols))
            .transform(lambda d: enrich_airline(d, airlines, cols, broadcast=broadcast[1], dedupe=dedupe_lookups)))


def transform(flights: DataFrame, airports: DataFrame, airlines: DataFrame,
              cols: FlightColumns = COLS, zone: str = LOCAL_ZONE,
              strict_times: bool = False, parse_times: bool = True,
              dedupe_lookups: bool = True, broadcast: tuple = (None, None)) -> DataFrame:
    """Raw flights → clean flights (the 24-column table).

    Steps are written in the original order; Catalyst pushes the status and
    not-null predicates to the scan and the country / type predicates into
    the (broadcast) airport side, and turns the left joins into inner joins.
    ``broadcast`` says for airports and airlines how they are joined
    (``session.lookup_side``). ``parse_times=False`` stops before the time parsing (times stay text).
    """
    out = (flights
           .transform(lambda d: map_rows(d, airports, airlines, cols, dedupe_lookups, broadcast))
           .transform(lambda d: remove_invalid_flights(d, cols))
           .transform(lambda d: late_flag(d, cols))
           .transform(drop_unused))
    return out.transform(lambda d: localise(d, cols.times, zone, strict_times)) if parse_times else out


def run_batch(spark: SparkSession, *, out_path: str, airports_path: str, airlines_path: str,
              raw_parquet: str | None = None, csv_glob: str | None = None,
              airports_fmt: str = "array", partition_by_year: bool = True,
              cols: FlightColumns = COLS) -> DataFrame:
    """Source choice → clean → write; returns the written table read back."""
    if raw_parquet and is_committed(spark, raw_parquet):
        raw = spark.read.parquet(raw_parquet)
    elif csv_glob:
        raw = read_flights_csv(spark, csv_glob)
    else:
        raise FileNotFoundError("no raw Parquet and no CSV glob to build the clean table from")
    airports = read_lookup_records(spark, airports_path, AIRPORT_FIELDS, airports_fmt)
    airlines = read_lookup_records(spark, airlines_path, AIRLINE_FIELDS, "array")
    write_clean(transform(raw, airports, airlines, cols), out_path, partition_by_year, cols)
    return spark.read.parquet(out_path)


def load_or_build(spark: SparkSession, clean_path: str, build: Callable[[], DataFrame] | None = None,
                  rebuild: bool = False) -> DataFrame:
    """Reuse the clean table when its write finished, else run ``build`` (which writes it).

    Unlike a silent no-op, a missing table without a way to build it raises.
    """
    if not rebuild and is_committed(spark, clean_path):
        return spark.read.parquet(clean_path)
    if build is None:
        raise FileNotFoundError(f"{clean_path} does not exist and no build step was given")
    return build()
