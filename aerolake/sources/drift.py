"""Parquet files whose columns and types change from file to file."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .csv import union_relaxed
from .files import list_files


def _merged(spark: SparkSession, paths: Sequence[str]) -> StructType | None:
    """The schema of files that agree on the type of every column they share, from
    their footers in one distributed job; None if they do not agree."""
    try:
        return spark.read.option("mergeSchema", True).parquet(*paths).schema
    except Exception as e:  # of the driver or, wrapped, of a task that merges some footers
        if "CANNOT_MERGE" not in str(e):
            raise
        return None


def schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[StructType, list[str]]]:
    """Files in groups whose members can be read together.

    Footers are merged by Spark for all files at once, and where that fails for
    each half: a type that changes once in the order of the names costs some twice
    the logarithm of the number of files in jobs, not one a file. Groups that
    agree are put together again.
    """
    whole = _merged(spark, paths)
    if whole is not None:
        return [(whole, list(paths))]
    half = len(paths) // 2
    groups: list[tuple[StructType, list[str]]] = []
    for schema, part in (*schema_groups(spark, paths[:half]), *schema_groups(spark, paths[half:])):
        types = {f.name: f.dataType for f in schema.fields}
        for k, (other, members) in enumerate(groups):
            known = {f.name: f.dataType for f in other.fields}
            if all(known.get(n, t) == t for n, t in types.items()):
                both = StructType([*other.fields, *[f for f in schema.fields if f.name not in known]])
                groups[k] = (both, members + part)
                break
        else:
            groups.append((schema, list(part)))
    return groups


def read_parquet_relaxed(spark: SparkSession, path: str | Iterable[str]) -> DataFrame:
    """All Parquet files at or below ``path`` (or a list of files) as one table: by
    column name, a column missing from a file is null, and columns of different types
    get a common type that holds the values of all. Partition folders are not
    read as columns."""
    files = [f for f, _, _ in list_files(spark, path)] if isinstance(path, str) else [str(p) for p in path]
    if not files:
        raise FileNotFoundError(f"no Parquet file at {path!r}")
    return union_relaxed([spark.read.schema(schema).parquet(*part) for schema, part in schema_groups(spark, files)])
