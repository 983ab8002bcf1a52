"""CSV ingest of flight extracts whose headers drift between files.

Spark's CSV reader maps columns *by position* when given a schema, so files
with different headers must not be read as one relation. Files are grouped
by their header line; each group is one distributed scan with an all-string
schema, and the groups are unioned by name.

Quotes inside quoted fields are doubled. A row with more or fewer fields than
the header fails the job (``mode="FAILFAST"``); ``mode="DROPMALFORMED"`` and
``"PERMISSIVE"`` are Spark's. Line breaks inside quotes need ``multi_line=True``:
UTF-8 files are then read by many tasks (:mod:`aerolake.sources.quoted`), others
as one split a file.
"""

from __future__ import annotations

import csv as _csv
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..columns import string_schema
from .files import expand_glob, first_lines
from .quoted import read_quoted_csv


def split_header(line: str, sep: str) -> list[str]:
    return next(_csv.reader([line], delimiter=sep), [])


def header_groups(spark: SparkSession, paths: Sequence[str], sep: str,
                  encoding: str = "UTF-8") -> dict[tuple[str, ...], list[str]]:
    groups: dict[tuple[str, ...], list[str]] = {}
    for p, line in zip(paths, first_lines(spark, paths, encoding)):
        groups.setdefault(tuple(split_header(line, sep)), []).append(p)
    return groups


def _reader(spark: SparkSession, header: Sequence[str], sep: str, encoding: str, mode: str, multi_line: bool):
    return (spark.read.schema(string_schema(header)).option("header", True).option("sep", sep)
            .option("encoding", encoding).option("mode", mode).option("multiLine", multi_line)
            .option("quote", '"').option("escape", '"'))


def _read(spark: SparkSession, paths: Sequence[str], header: Sequence[str], sep: str, encoding: str, mode: str, multi_line: bool) -> DataFrame:
    if multi_line and encoding.upper().replace("-", "") == "UTF8" and mode != "DROPMALFORMED":
        return read_quoted_csv(spark, paths, header, sep, mode)
    return _reader(spark, header, sep, encoding, mode, multi_line).csv(list(paths))


def read_flights_csv(spark: SparkSession, paths: str | Iterable[str], sep: str = ";", encoding: str = "UTF-8",
                     mode: str = "FAILFAST", multi_line: bool = False) -> DataFrame:
    """Read every CSV matched by ``paths`` (a glob or a list of files) and
    union them by column name; all columns are text (flight numbers and
    codes keep their leading zeros), a column missing from a file is null."""
    files = expand_glob(spark, paths) if isinstance(paths, str) else [str(p) for p in paths]
    if not files:
        raise FileNotFoundError(f"no CSV file matches {paths!r}")
    return union_relaxed([_read(spark, group, header, sep, encoding, mode, multi_line)
                          for header, group in header_groups(spark, files, sep, encoding).items() if header])


def read_csv(spark: SparkSession, path: str, sep: str = ",", encoding: str = "UTF-8",
             mode: str = "FAILFAST", multi_line: bool = False) -> DataFrame:
    """CSV with header (one file, or files with equal headers in a folder), all columns as text."""
    files = expand_glob(spark, path) or expand_glob(spark, f"{path.rstrip('/')}/[!_.]*")
    if not files:
        raise FileNotFoundError(f"no CSV file at {path!r}")
    header = split_header(first_lines(spark, files[:1], encoding)[0], sep)
    return _read(spark, [path], header, sep, encoding, mode, multi_line)


_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_INTEGER_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """Common type of two numeric types that holds the values of both."""
    if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
        return max(a, b, key=lambda t: _INTEGERS.index(type(t)))
    if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
        small = (T.FloatType, T.ByteType, T.ShortType)  # what a 32-bit float holds exactly
        return T.FloatType() if isinstance(a, small) and isinstance(b, small) else T.DoubleType()
    (p, s), (q, u) = ((t.precision, t.scale) if isinstance(t, T.DecimalType) else (_INTEGER_DIGITS[type(t)], 0)
                      for t in (a, b))
    scale = max(s, u)
    return T.DecimalType(min(38, max(p - s, q - u) + scale), scale)


def common_type(types: Iterable[T.DataType]) -> T.DataType:
    """Supertype for a relaxed union: widen numerics, anything else mixed → string.

    (Spark's own coercion picks BIGINT for int + string and then fails at run
    time on non-numeric text.)
    """
    types = [t for t in types if not isinstance(t, T.NullType)] or [T.StringType()]
    out = types[0]
    for t in types[1:]:
        if t == out:
            continue
        if isinstance(out, T.NumericType) and isinstance(t, T.NumericType):
            out = _wider(out, t)
        elif all(isinstance(x, (T.TimestampType, T.TimestampNTZType, T.DateType)) for x in (out, t)):
            out = T.TimestampNTZType() if any(isinstance(x, T.TimestampNTZType) for x in (out, t)) else T.TimestampType()
        else:
            return T.StringType()
    return out


def union_relaxed(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; missing columns → null, differing types → common type."""
    if not frames:
        raise ValueError("nothing to union")
    seen: dict[str, list[T.DataType]] = {}
    for df in frames:
        for f in df.schema.fields:
            seen.setdefault(f.name, []).append(f.dataType)
    target = {name: common_type(ts) for name, ts in seen.items()}
    out = None
    for df in frames:
        have = set(df.columns)
        aligned = df.select([(F.col(f"`{n}`").cast(t) if n in have else F.lit(None).cast(t)).alias(n)
                             for n, t in target.items()])
        out = aligned if out is None else out.unionByName(aligned)
    return out
