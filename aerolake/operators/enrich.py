"""Lookup joins and dictionary decodes of the flight records.

Lookups are dimension tables: they are de-duplicated, and broadcast if their
measured bytes are few (the flight table then streams through map-side hash
joins with no shuffle); a larger lookup is joined with a shuffle join that
keeps heavy keys out of single tasks (:mod:`aerolake.operators.hotkeys`).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..codes import (AIRPORT_SIZE_DEFAULT, AIRPORT_SIZES, CODE_NOT_FOUND, HELIPORT,
                     JUSTIFICATIONS, LINE_TYPES)
from ..columns import AIRLINE_FIELDS, AIRPORT_FIELDS, COLS, FlightColumns
from ..functions.decode import decode
from ..session import MAX_BROADCAST_BYTES, are_small
from .hotkeys import lookup_join
from .projection import select_cast

_ORD = "__ordinal"


def _source_order(df: DataFrame) -> list[Column]:
    """Where a row stood in its source: file, then place in the file."""
    place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start")]
    try:
        if df._jdf.queryExecution().analyzed().collectLeaves().size() != 1:  # joined tables: no one file
            place = []
        df.select(*place)
    except AnalysisException:  # rows that come from no file
        place = []
    return [*place, F.monotonically_increasing_id()]


def first_by_key(df: DataFrame, key: str, order_by: str | Column | None = None) -> DataFrame:
    """Keep the first row per ``key`` (null key kept once as its own group).

    "First" is the smallest ``order_by``; without one, the source order: files
    by path, rows as they stand in a file. Runs as ``min_by`` with partial
    aggregation, so a hot key is combined map-side before the shuffle.
    """
    others = [c for c in df.columns if c != key]
    order = _source_order(df) if order_by is None else [F.col(order_by) if isinstance(order_by, str) else order_by]
    keyed = df.withColumn(_ORD, F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))
    packed = F.struct(*[F.col(f"`{c}`") for c in others])
    out = keyed.groupBy(F.col(f"`{key}`")).agg(F.min_by(packed, F.col(_ORD)).alias("__row"))
    return out.select(F.col(f"`{key}`"), *[F.col("__row").getField(c).alias(c) for c in others])


def airport_dimension(airports: DataFrame) -> DataFrame:
    """Airport records → string table unique on ``icao_code`` (first wins)."""
    return first_by_key(select_cast(airports, AIRPORT_FIELDS), "icao_code")


def airline_dimension(airlines: DataFrame) -> DataFrame:
    """Airline records → string table unique on ``Sigla`` (first wins)."""
    return first_by_key(select_cast(airlines, AIRLINE_FIELDS), AIRLINE_FIELDS[1])


def _endpoint(dim: DataFrame, key: str, names: dict[str, str]) -> DataFrame:
    return dim.select(F.col("icao_code").alias(key),
                      *[F.col(src).alias(dst) for src, dst in names.items()])


def enrich_airports(flights: DataFrame, airports: DataFrame, cols: FlightColumns = COLS,
                    decode_sizes: bool = True, broadcast: bool | int | None = None,
                    dedupe: bool = True) -> DataFrame:
    """Join origin and destination airport attributes, keep flights whose two
    endpoints are known and not heliports, and decode the airport size.

    ``broadcast``: see :func:`aerolake.operators.hotkeys.lookup_join`; ``dedupe=False``
    when ``airports`` already is an :func:`airport_dimension`."""
    dim = airport_dimension(airports) if dedupe else select_cast(airports, AIRPORT_FIELDS)
    if broadcast is None or not isinstance(broadcast, bool):  # measured once for both ends
        limit = MAX_BROADCAST_BYTES if broadcast is None else broadcast
        broadcast = True if not flights.isStreaming and are_small([dim], limit)[0] else 0
    origin = _endpoint(dim, cols.origin_icao, {
        "name": cols.origin_name, "continent": cols.origin_continent,
        "iso_country": cols.origin_country, "municipality": cols.origin_city,
        "gps_code": cols.origin_gps, "coordinates": cols.origin_coords,
        "type": cols.origin_size})
    dest = _endpoint(dim, cols.dest_icao, {
        "name": cols.dest_name, "continent": cols.dest_continent,
        "iso_country": cols.dest_country, "municipality": cols.dest_city,
        "gps_code": cols.dest_gps, "coordinates": cols.dest_coords,
        "type": cols.dest_size})
    out = lookup_join(flights, origin, cols.origin_icao, cols.origin_icao, broadcast)
    out = lookup_join(out, dest, cols.dest_icao, cols.dest_icao, broadcast)
    out = known_endpoints(out, cols)
    if decode_sizes:
        out = out.withColumns({
            cols.origin_size: decode(cols.origin_size, AIRPORT_SIZES, AIRPORT_SIZE_DEFAULT),
            cols.dest_size: decode(cols.dest_size, AIRPORT_SIZES, AIRPORT_SIZE_DEFAULT),
        })
    return out


def known_endpoints(df: DataFrame, cols: FlightColumns = COLS) -> DataFrame:
    """Both endpoint types known and not a heliport (raw type, before decode).

    The null-rejecting predicate lets Catalyst turn the left joins into inner
    joins and push the type predicate into the dimension side.
    """
    o, d = F.col(f"`{cols.origin_size}`"), F.col(f"`{cols.dest_size}`")
    return df.filter(o.isNotNull() & (o != HELIPORT) & d.isNotNull() & (d != HELIPORT))


def enrich_airline(flights: DataFrame, airlines: DataFrame, cols: FlightColumns = COLS,
                   broadcast: bool | int | None = None, dedupe: bool = True) -> DataFrame:
    """Left join of the airline name on the airline ICAO code; unmatched → null."""
    name, code = AIRLINE_FIELDS
    dim = airline_dimension(airlines) if dedupe else select_cast(airlines, AIRLINE_FIELDS)
    dim = dim.select(F.col(name).alias(cols.airline), F.col(code).alias("icao_empresa"))
    return lookup_join(flights.drop(cols.airline), dim, cols.airline_icao, "icao_empresa", broadcast)


def decode_codes(df: DataFrame, cols: FlightColumns = COLS,
                 justifications: dict[str, str] = JUSTIFICATIONS,
                 line_types: dict[str, str] = LINE_TYPES) -> DataFrame:
    """Decode the justification and line-type codes to labels."""
    return df.withColumns({
        cols.reason: decode(F.col(f"`{cols.reason_code}`"), justifications, CODE_NOT_FOUND),
        cols.line_type: decode(F.col(f"`{cols.line_type_code}`"), line_types, CODE_NOT_FOUND),
    })


def decode_with_table(df: DataFrame, code_col: str, codes: DataFrame, out_col: str,
                      default: str | None = CODE_NOT_FOUND,
                      broadcast: bool | int | None = None) -> DataFrame:
    """Decode through a (code, label) table, e.g. one read with ``read_code_map``,
    for code lists that are not known when the job is written; of equal codes the first counts."""
    dim = first_by_key(codes.select("code", "label"), "code").select("code", F.col("label").alias("__label"))
    joined = lookup_join(df, dim, code_col, "code", broadcast)
    label = F.col("__label") if default is None else F.coalesce(F.col("__label"), F.lit(default))
    return joined.withColumn(out_col, F.when(F.col(f"`{code_col}`").isNotNull(), label)).drop("__label")
