"""Small helpers shared by the operators: shared folders, text batches, splits."""

from __future__ import annotations

import ctypes
import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Spaces of the word and normalisation rules: [\x20\x09-\x0D].
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Text handled at once inside a Python worker; a longer document comes alone.
CHUNK_CHARS = 4 << 20


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors share.

    Only a local session without that setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set")
        root = tempfile.mkdtemp(prefix="aerolake-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    # With its file system's scheme, so that it means the same to every reader.
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return f"{fs.makeQualified(path).toString().rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the
    lineage, and survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside removes its shuffle files at its end; else they stay
    until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def broadcast_if_small(df: DataFrame, rows: int = 2_000_000) -> DataFrame:
    """For tables of a few numbers a row: broadcast up to ``rows`` (about 64 MB),
    a plain join beyond."""
    return F.broadcast(df) if df.count() <= rows else df


def held_out(doc_id: Column) -> Column:
    """The rows no model may learn from: crc32 of the id's text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sampled(key: Column, share: float, salt: str) -> Column:
    """A deterministic sample of about ``share`` of the keys."""
    return F.pmod(F.xxhash64(F.lit(salt), key), F.lit(1 << 30)) < int(share * (1 << 30))


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text each (one
    longer document alone)."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)


def bound_batches(spark: SparkSession) -> None:
    """Let Spark hand Python workers batches of at most ``CHUNK_CHARS`` bytes: the
    default of 64 MB, copied a few times, is much for documents."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, "67108864b").rstrip("b")) > CHUNK_CHARS:
        spark.conf.set(key, f"{CHUNK_CHARS}b")


def schema(first: StructField, rest: str) -> StructType:
    """A schema of a given field, renamed or not, and fields in DDL."""
    return StructType([first, *StructType.fromDDL(rest).fields])


def release() -> None:
    """Give the memory that a finished slice left free back to the system: Python
    workers live on between tasks and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType,
              text: str = "text", limit: int = CHUNK_CHARS) -> DataFrame:
    """``mapInArrow`` over slices of bounded text size."""
    bound_batches(df.sparkSession)

    def run(batches):
        import pyarrow.compute  # noqa: F401  (pa.compute inside the worker)
        for chunk in text_chunks(batches, text, limit):
            yield fn(chunk)
            release()
    return df.mapInArrow(run, schema)


def ship(spark: SparkSession, value) -> Callable:
    """Broadcast ``value`` by value; the result gives it back inside a task."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    opened: list = []

    def get():
        if not opened:
            opened.append(pickle.loads(packed.value))
            # The worker would keep the packed bytes of every broadcast it has seen.
            packed.__dict__.pop("_value", None)
        return opened[0]
    return get
