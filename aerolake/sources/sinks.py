"""Writers: clean table, exports, CSV → NDJSON conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..columns import COLS, FlightColumns
from .csv import read_csv

YEAR_PARTITION = "ano_partida"


def with_year_partition(df: DataFrame, cols: FlightColumns = COLS,
                        name: str = YEAR_PARTITION) -> DataFrame:
    return df.withColumn(name, F.year(F.col(f"`{cols.dep_planned}`")))


def write_clean(df: DataFrame, path: str, partition_by_year: bool = True,
                cols: FlightColumns = COLS, mode: str = "overwrite",
                rows_per_file: int = 20_000_000, cluster_by: Sequence[str] = ()) -> None:
    """Persist the clean table as Parquet, partitioned by the planned
    departure year so that day-range filters prune whole years.

    Rows are rebalanced by year: adaptive execution splits a year that holds
    most of the flights over several tasks and puts small years together, so
    there are files in proportion to the data, not tasks times years.

    With ``cluster_by`` (airport or airline columns that lists filter on) rows
    are dealt out in ranges of the year and these columns and sorted by them in each
    file, so that the row groups' least and greatest values let a scan skip
    most of them; Bloom filters serve the columns behind the first."""
    options = {"maxRecordsPerFile": rows_per_file}
    if cluster_by:
        for c in cluster_by[1:]:
            options[f"parquet.bloom.filter.enabled#{c}"] = "true"
        keys = [F.col(f"`{c}`") for c in cluster_by]
        year = [F.col(YEAR_PARTITION)] if partition_by_year else []
        df = with_year_partition(df, cols) if partition_by_year else df
        df = df.repartitionByRange(*year, *keys).sortWithinPartitions(*year, *keys)
    elif partition_by_year:
        df = with_year_partition(df, cols).hint("rebalance", F.col(YEAR_PARTITION))
    writer = df.write.mode(mode).options(**options)
    (writer.partitionBy(YEAR_PARTITION) if partition_by_year else writer).parquet(path)


def export_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def export_csv(df: DataFrame, path: str, mode: str = "overwrite", sep: str = ",") -> None:
    """CSV with header; quotes inside fields are doubled, as other tools expect."""
    df.write.mode(mode).option("header", True).option("sep", sep).option("escape", '"').csv(path)


def csv_to_ndjson(spark: SparkSession, src: str, dst: str, mode: str = "overwrite", sep: str = ",",
                  encoding: str = "UTF-8", multi_line: bool = True, compression: str = "none",
                  rows_per_file: int = 1_000_000) -> None:
    """CSV with header → newline-delimited JSON (one object per row). Any valid CSV:
    quoted fields may hold line breaks, unless ``multi_line=False`` rules them out.

    Every row repeats all names, so the files are several times the CSV's: ``compression="gzip"``
    keeps them small. A compressed file is read by one task, hence the bound on its rows."""
    options = {"compression": compression} | ({} if compression == "none" else {"maxRecordsPerFile": rows_per_file})
    read_csv(spark, src, sep, encoding, multi_line=multi_line).write.mode(mode).options(**options).json(dst)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_parquet_bytes(spark: SparkSession, data: bytes, name: str = "upload.parquet") -> DataFrame:
    """A Parquet file handed over as bytes (e.g. an upload): landed once under
    the shared checkpoint folder, then read by Spark like any table."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from .files import write_bytes
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landing/{uuid.uuid4().hex}/{name}"
    write_bytes(spark, path, data)
    return spark.read.parquet(path)
