"""Spark session settings and the few plan-level helpers shared by operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lineage import identity

# Settings every job relies on: wall-clock semantics need a UTC session zone,
# ANSI keeps casts honest, AQE re-plans joins/partitions from runtime sizes.
BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Largest lookup (airports, airlines, code lists) that is shipped to every
# task, in bytes of its rows. Real airport lists are ~10 MB.
MAX_BROADCAST_BYTES = 64 << 20


def build_session(master: str | None = None, app_name: str = "aerolake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # Settings that may be changed on a live session.
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled",
              "spark.sql.adaptive.enabled"):
        spark.conf.set(k, conf[k])
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins; ``fallback`` is only used when the
    setting is absent (local tests).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    path = configured or fallback
    if not path:
        raise ValueError("spark.checkpoint.dir is not set and no fallback was given")
    if not configured:
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def row_bytes(df: DataFrame) -> Column:
    """Bytes of one row: 8 for each column, and the text of text columns."""
    width = F.lit(16 + 8 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif not isinstance(f.dataType, T.AtomicType):
            return F.lit(None).cast("long")  # nested values are not measured, and not broadcast
    return width


def _in_one_job(rows: list[DataFrame]) -> dict:
    one = rows[0]
    for row in rows[1:]:
        one = one.unionAll(row)
    return {r.k: r.value for r in one.collect()}


# What was measured in this process, by session, plan and file versions.
_MEASURED: dict[tuple, int | None] = {}


def sizes(frames: Sequence[DataFrame], limit: int = MAX_BROADCAST_BYTES) -> list[int | None]:
    """Measured bytes of each frame: None if nested, and more than ``limit``, but
    otherwise not exact, for one whose row count alone is too large.

    Rows are counted first, which reads no column of a file relation. Only
    texts of frames with few enough rows are read, so no large table is. A frame
    with the same plan over the same files is measured once in a session.
    """
    out: list[int | None] = [None] * len(frames)
    keys = {}
    for k, df in enumerate(frames):
        known = identity(df)
        keys[k] = None if known is None else (df.sparkSession.sparkContext.applicationId, known.plan, known.versions, limit)
    fresh = [k for k in keys if keys[k] is None or keys[k] not in _MEASURED]
    plain = {k: all(isinstance(f.dataType, T.AtomicType) for f in frames[k].schema.fields) for k in fresh}
    width = {k: 16 + 8 * len(frames[k].columns) for k in fresh}
    one = lambda k, c: frames[k].agg(F.lit(k).alias("k"), c.cast("long").alias("value"))
    measured = [k for k in fresh if plain[k]]
    rows = _in_one_job([one(k, F.count("*")) for k in measured]) if measured else {}
    found: dict = {k: rows[k] * width[k] for k in measured}
    texts = [k for k in measured if 0 < found[k] <= limit and any(isinstance(f.dataType, T.StringType) for f in frames[k].schema.fields)]
    if texts:
        found.update(_in_one_job([one(k, F.sum(row_bytes(frames[k]))) for k in texts]))
    for k in fresh:
        if keys[k] is not None:
            _MEASURED[keys[k]] = found.get(k)
    for k in keys:
        out[k] = found.get(k) if k in fresh else _MEASURED[keys[k]]
    return out


def lookup_sides(frames: Sequence[DataFrame], limit: int = MAX_BROADCAST_BYTES) -> list[DataFrame]:
    """How lookups join the fact table: broadcast while the measured bytes stay
    within ``limit``, else a shuffle join.

    The planner's own estimate is not relied on: without statistics it
    multiplies join inputs and can miss a 25-row table, and adaptive execution
    would switch only after the fact table was already shuffled.
    """
    return [F.broadcast(df) if small else df for df, small in zip(frames, are_small(frames, limit))]


def are_small(frames: Sequence[DataFrame], limit: int = MAX_BROADCAST_BYTES) -> list[bool]:
    return [size is not None and size <= limit for size in sizes(frames, limit)]


def lookup_side(df: DataFrame, broadcast: bool | int | None = None) -> DataFrame:
    """One lookup: ``None`` measures it against ``MAX_BROADCAST_BYTES``, an ``int``
    against that many bytes; ``True`` is for a caller who has measured it, and
    ``False`` leaves the choice to Spark's thresholds."""
    if broadcast is True:
        return F.broadcast(df)
    if broadcast is False:
        return df
    return lookup_sides([df], MAX_BROADCAST_BYTES if broadcast is None else int(broadcast))[0]
