"""Exact deduplication with stateful streaming.

A streaming aggregation keeps one state entry per digest of the normalised
text, on disk (RocksDB) and without expiry: the smallest document id, the file
that holds that document (the content locator) and the number of documents.
New files only add to the state. The state is read back as a table and gives the
answers: documents whose digest it holds more than once are hits, kept under the
state's id with the state's count, once their full normalised bytes have been
compared with those of the document that the locator names. Digests that fail
this (different texts of one digest, or files that changed after the state had
seen them) are grouped by their bytes. Only Spark SQL functions are used.

Copies are combined inside each task before every shuffle, so a text that a
third of all rows share is one row per task. Hits too many to broadcast are joined
by digest, the heavy ones, which the state's counts show, apart from the rest.

Defined cases: a null text is empty; documents with equal ids are all kept or
all dropped, and each counts in the group; a null id loses against any id;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.hotkeys import hot_key_join
from .common import SPACES, materialize, shared_dir

# Hits (digests with more than one document) that may be broadcast: 64 hex
# digits and a few numbers each, about 100 MB at most.
BROADCAST_HITS = 500_000

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # A run has few, large batches: stores are closed after each, or every
    # partition's open store would hold preallocated files on its executor.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _keyed(docs: DataFrame, digest: Callable[[Column], Column], *more: Column) -> DataFrame:
    return docs.select("doc_id", normalised(F.col("text")).alias("text"), *more) \
        .withColumn("digest", digest(F.col("text")))


def _entry(file: Column) -> Column:
    """A document as the state orders them: rows without id last."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", file.alias("file"))


def ingest(spark: SparkSession, source: str, state: str, digest: Callable[[Column], Column] = sha256,
           bytes_per_batch: int = 64 << 30, files_per_batch: int | None = None) -> None:
    """Add the Parquet files of ``source`` that ``state`` has not seen yet to it."""
    stream = spark.readStream.schema(spark.read.parquet(source).schema)
    stream = stream.option("maxFilesPerTrigger", files_per_batch) if files_per_batch \
        else stream.option("maxBytesPerTrigger", bytes_per_batch)
    # As a pattern, the path may name a folder of files or a single file.
    path = source.rstrip("/")
    docs = stream.parquet(f"{path[:-1]}[{path[-1]}]")
    groups = (_keyed(docs, digest, F.col("_metadata.file_path").alias("file"))
              .groupBy("digest").agg(F.min(_entry(F.col("file"))).alias("first"), F.count("*").alias("n")))
    with _settings(spark, STATE_CONF):
        query = (groups.writeStream.outputMode("update").format("noop")
                 .option("checkpointLocation", state).trigger(availableNow=True).start())
        query.awaitTermination()


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """``digest, doc_id, file, n``: the keyed state of all files seen so far."""
    with _settings(spark, STATE_CONF):
        table = spark.read.format("statestore").load(state)
    return table.select("key.digest", "value.*").select("digest", "min.doc_id", "min.file", F.col("count").alias("n"))


def _heavy(hits: DataFrame, rows: int) -> list[str]:
    """Digests with a quarter of a task's even share of the rows, or more: at most four
    times the number of tasks."""
    tasks = int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return sorted(r.digest for r in hits.where(F.col("n") >= rows / (4 * tasks)).select("digest").collect())


def deduplicate(spark: SparkSession, source: str, state: str | None = None,
                digest: Callable[[Column], Column] = sha256, **batches) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest`` of every document of ``source``."""
    state = state or shared_dir(spark, "dedup-state")
    ingest(spark, source, state, digest, **batches)
    docs = spark.read.parquet(source)
    # A hit's row is narrow: of its locator's path only a hash.
    hits = materialize(read_state(spark, state).where("n > 1").select(
        "digest", F.col("doc_id").alias("keep_id"), F.xxhash64("file").alias("keep_file"), "n"), "dedup-hits")
    few = hits.count() <= BROADCAST_HITS
    heavy = [] if few else _heavy(hits, docs.count())
    keyed = _keyed(docs, digest, F.xxhash64("_metadata.file_path").alias("file"))

    def by_digest(rows: DataFrame, side: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(side), "digest", "left") if few else hot_key_join(rows, side, "digest", "digest", heavy)

    # Equal bytes are counted, copies first within each task. All documents of the
    # digest must have the bytes of the one that the locator names.
    members = by_digest(keyed, hits).where("n is not null")
    located = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("file") == F.col("keep_file"))
    equal = members.groupBy("digest", "keep_id", "n", "text").agg(
        F.count("*").alias("equal"), F.max(located).alias("located"))
    checked = equal.where("located and equal = n").select("digest", F.lit(True).alias("checked"))
    answers = materialize(hits.join(checked, "digest", "left").select("digest", "keep_id", "n", F.coalesce(
        "checked", F.lit(False)).alias("checked")), "dedup-answers")
    # A document that is no hit keeps itself.
    out = by_digest(keyed.select("doc_id", "file", "digest"), answers).where("checked is null or checked").select(
        "doc_id", F.when(F.col("checked"), F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), "digest")
    failed = answers.where("not checked")
    if not failed.isEmpty():
        # These alone are grouped and joined by their bytes.
        mixed = keyed.join(failed.select("digest"), "digest", "left_semi")
        by_text = mixed.groupBy("digest", "text").agg(F.min(_entry(F.col("file"))).alias("first"), F.count("*").alias("group_size"))
        out = out.unionByName(mixed.join(by_text, ["digest", "text"]).select(
            "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", "digest"))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")
