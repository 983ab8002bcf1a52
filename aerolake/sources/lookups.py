"""Lookup sources: JSON records (airports, airlines) and JSON code maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..columns import string_schema


def read_lookup_records(spark: SparkSession, path: str, columns: Sequence[str],
                        fmt: str = "array") -> DataFrame:
    """JSON records → string table with ``columns``.

    ``fmt="array"``: one JSON array of objects (possibly spread over lines);
    ``fmt="ndjson"``: one object per line. The mode must be stated:
    multi-line mode on NDJSON silently returns only the first record.
    """
    if fmt not in ("array", "ndjson"):
        raise ValueError(f"unknown JSON layout {fmt!r}")
    return (spark.read.schema(string_schema(columns))
            .option("multiLine", fmt == "array").json(path))


def read_code_map(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object ``{code: label, ...}`` → rows ``(code, label)``."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", "map<string,string>"))
                       .alias("code", "label"))
