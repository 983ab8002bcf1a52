"""Incremental ingest: new CSV extracts → clean flight table, with Structured Streaming.

The cleaning pipeline is stateless (filters, derived columns) plus joins with
static lookup tables, so the same ``transform`` runs on a file stream. Each
new file in ``source_dir`` is cleaned once and appended to the Parquet sink;
progress lives in the checkpoint folder, so a restarted or failed run resumes
without reprocessing or losing files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..codes import LOCAL_ZONE
from ..columns import COLS, FlightColumns, string_schema
from ..operators.enrich import airline_dimension, airport_dimension
from ..plans.transform import transform
from ..session import ensure_checkpoint_dir


def read_flights_stream(spark: SparkSession, source_dir: str, header: Sequence[str],
                        sep: str = ";", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming CSV source with a declared all-text schema.

    ``enforceSchema=false`` makes Spark check every file's header against
    ``header`` (CSV columns are matched by position), so a file with a
    drifted header fails the batch instead of shifting values between
    columns; such files belong to another stream or to the batch reader.
    """
    reader = (spark.readStream.schema(string_schema(header))
              .option("header", True).option("sep", sep).option("escape", '"').option("enforceSchema", False))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(source_dir)


def stream_clean(spark: SparkSession, source_dir: str, header: Sequence[str],
                 airports: DataFrame, airlines: DataFrame, sink_path: str,
                 checkpoint_path: str | None = None, name: str = "clean_flights",
                 sep: str = ";", available_now: bool = True,
                 cols: FlightColumns = COLS, zone: str = LOCAL_ZONE) -> StreamingQuery:
    """Start the incremental clean job; ``available_now`` processes the files
    present now and stops (a scheduled batch), otherwise it keeps running."""
    if checkpoint_path is None:
        checkpoint_path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    # Lookups are de-duplicated once and cut from their lineage (reliable
    # checkpoint under the shared folder); the stream then joins static tables.
    ensure_checkpoint_dir(spark)
    airport_dim = airport_dimension(airports).checkpoint()
    airline_dim = airline_dimension(airlines).checkpoint()
    stream = read_flights_stream(spark, source_dir, header, sep)
    clean = transform(stream, airport_dim, airline_dim, cols, zone, dedupe_lookups=False)
    writer = (clean.writeStream.format("parquet").outputMode("append")
              .option("path", sink_path).option("checkpointLocation", checkpoint_path)
              .queryName(name))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
