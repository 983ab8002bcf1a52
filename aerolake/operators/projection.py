"""Projection helpers: cast-and-alias select, strict drop."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_cast(df: DataFrame, columns: Mapping[str, str] | Iterable[str],
                dtype: str = "string") -> DataFrame:
    """Pick columns, cast each to ``dtype`` and alias it (``{source: alias}``)."""
    mapping = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    return df.select([F.col(f"`{src}`").cast(dtype).alias(dst) for src, dst in mapping.items()])


def drop_strict(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop columns; naming an absent column is an error (Spark's own ``drop``
    silently ignores it)."""
    columns = list(columns)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"cannot drop absent columns: {missing}")
    return df.drop(*columns)
