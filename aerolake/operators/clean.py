"""Row filters and derived columns of the cleaning pipeline."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..codes import DOMESTIC_COUNTRY, LOCAL_ZONE, SITUATION_DONE, STATUS_LATE, STATUS_OK
from ..columns import COLS, DROPPED_AFTER_CLEAN, FlightColumns
from ..functions.times import parse_local_time, valid_local_time
from .projection import drop_strict


def _col(name: str):
    return F.col(f"`{name}`")


def completed_flights(df: DataFrame, cols: FlightColumns = COLS,
                      situation: str = SITUATION_DONE) -> DataFrame:
    """Flown flights with all four planned/real times present."""
    cond = _col(cols.situation) == situation
    for c in cols.times:
        cond = cond & _col(c).isNotNull()
    return df.filter(cond)


def domestic_only(df: DataFrame, cols: FlightColumns = COLS,
                  country: str = DOMESTIC_COUNTRY) -> DataFrame:
    """Both endpoints in ``country``."""
    return df.filter((_col(cols.origin_country) == country) & (_col(cols.dest_country) == country))


def remove_invalid_flights(df: DataFrame, cols: FlightColumns = COLS) -> DataFrame:
    return domestic_only(completed_flights(df, cols), cols)


def late_flag(df: DataFrame, cols: FlightColumns = COLS) -> DataFrame:
    """Late if the real departure or the real arrival is after the planned one.

    Compared as stored (text ``YYYY-MM-DD HH:MM:SS`` sorts like time); a null
    comparison counts as not late.
    """
    late = ((_col(cols.dep_real) > _col(cols.dep_planned))
            | (_col(cols.arr_real) > _col(cols.arr_planned)))
    return df.withColumn(cols.status, F.when(late, STATUS_LATE).otherwise(STATUS_OK))


def drop_unused(df: DataFrame, columns: Iterable[str] = DROPPED_AFTER_CLEAN) -> DataFrame:
    return drop_strict(df, columns)


def localise(df: DataFrame, prefixes: Iterable[str] = COLS.times, zone: str = LOCAL_ZONE,
             strict: bool = False) -> DataFrame:
    """Every column whose name starts with one of ``prefixes`` becomes a local
    wall-clock ``TIMESTAMP_NTZ`` in ``zone``.

    Text is parsed leniently (malformed → null). ``strict=True`` fails the job
    on a wall-clock time that does not exist or is ambiguous in ``zone``.
    """
    prefixes = tuple(prefixes)
    out = {}
    for field in df.schema.fields:
        if not field.name.startswith(prefixes):
            continue
        c = _col(field.name)
        if isinstance(field.dataType, T.StringType):
            t = parse_local_time(c)
        elif isinstance(field.dataType, T.TimestampNTZType):
            t = c
        elif isinstance(field.dataType, T.TimestampType):
            t = F.convert_timezone(F.lit("UTC"), F.lit(zone), c.cast("timestamp_ntz"))
        elif isinstance(field.dataType, T.DateType):
            t = c.cast("timestamp_ntz")
        else:
            raise TypeError(f"cannot localise {field.name}: {field.dataType.simpleString()}")
        if strict:
            t = F.when(t.isNull() | valid_local_time(t, zone), t).otherwise(
                F.raise_error(F.concat(F.lit(f"invalid local time in {zone} for {field.name}: "),
                                       t.cast("string"))))
        out[field.name] = t
    return df.withColumns(out) if out else df


def invalid_local_times(df: DataFrame, columns: Iterable[str] = COLS.times,
                        zone: str = LOCAL_ZONE) -> DataFrame:
    """Rows with at least one non-existent or ambiguous local time.

    The validity test reads each time several times. A plain filter would be
    pushed into the projection that parses the times and repeat the parse
    for every reference, so the times first pass through a generator
    (``inline`` of a one-element array): filters are not pushed below it, and
    each time is parsed once per row.
    """
    columns = list(columns)
    others = [c for c in df.columns if c not in columns]
    once = F.inline(F.array(F.struct(*[_col(c).alias(c) for c in columns])))
    pinned = df.select(*[_col(c) for c in others], once)
    bad = None
    for c in columns:
        cond = ~valid_local_time(_col(c), zone)          # null time → null → not kept
        bad = cond if bad is None else (bad | cond)
    return pinned.filter(bad).select(*[_col(c) for c in df.columns])


def unparsable_times(df: DataFrame, columns: Iterable[str] = COLS.times) -> DataFrame:
    """Per time column, how many texts are present but not a whole timestamp:
    ``coluna, presentes, ilegiveis``. (They stay null after ``localise``.)

    One pass; each column's counts are combined map-side.
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("coluna"), _col(c).cast("string").alias("valor")) for c in columns]))
    bad = F.col("valor").isNotNull() & parse_local_time("valor").isNull()
    return (df.select(pairs).groupBy("coluna")
              .agg(F.count("valor").alias("presentes"), F.count_if(bad).alias("ilegiveis")))
