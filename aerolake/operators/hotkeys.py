"""Lookup joins: map-side while the lookup is small, else shuffled with the heavy
keys taken out.

Joining a lookup too large to broadcast sends all flights of a key to one task,
and an airline may have a third of them. A sample of the flights shows which
keys are heavy. Only their lookup rows are broadcast, and their flights, as
those without a key, are dealt out evenly in the shuffle, where they match
nothing: one pass over the flights, one shuffle, no key in one task. The sample
decides where rows meet, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import MAX_BROADCAST_BYTES, are_small

# Share of the rows looked at, and the rows of a key that a sample must show at least.
SAMPLE, SEEN = 0.01, 16


def heavy_keys(facts: DataFrame, key: Column, tasks: int | None = None, sample: float = SAMPLE) -> list:
    """Keys with at least a quarter of a task's even share of the rows: at most four
    times the number of tasks."""
    tasks = tasks or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = facts.select(key.alias("k")).sample(sample, 17).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    least = F.greatest(F.lit(SEEN), F.sum("n").over(_everything()) / (4 * tasks))
    # Only keys seen often enough reach the one window.
    rows = counts.where(F.col("n") >= SEEN).withColumn("least", least).where("n >= least and k is not null").collect()
    return sorted(r.k for r in rows)


def _everything():
    from pyspark.sql import Window
    return Window.partitionBy()


def hot_key_join(facts: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str, heavy: list | None = None,
                 tasks: int | None = None) -> DataFrame:
    """Left join of ``lookup``, unique on ``lookup_key``, which is left out."""
    key = F.col(f"`{fact_key}`")
    heavy = heavy_keys(facts, key, tasks) if heavy is None else heavy
    values = [c for c in lookup.columns if c != lookup_key]
    tasks = tasks or int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]), F.lit(8 * tasks))
    is_heavy = key.isin(heavy) if heavy else F.lit(False)
    dealt = facts.withColumn("__deal", F.when(key.isNull() | is_heavy, spread).otherwise(F.lit(-1).cast("long")))

    def side(df: DataFrame, prefix: str) -> DataFrame:
        return df.select(F.col(f"`{lookup_key}`").alias(f"{prefix}key"), *[F.col(f"`{c}`").alias(f"{prefix}{c}") for c in values])
    # -1, but computed: a literal would be folded out of the join's keys.
    rest = side(lookup, "__l_").withColumn("__d", F.pmod(F.xxhash64("__l_key"), F.lit(1)) - 1)
    out = dealt.join(rest, (key == F.col("__l_key")) & (F.col("__deal") == F.col("__d")), "left")
    found = [F.col(f"`__l_{c}`") for c in values]
    if heavy:
        few = side(lookup.where(F.col(f"`{lookup_key}`").isin(heavy)), "__h_")  # a row a heavy key at most
        out = out.join(F.broadcast(few), key == F.col("__h_key"), "left")
        found = [F.when(F.col("__deal") >= 0, F.col(f"`__h_{c}`")).otherwise(x) for c, x in zip(values, found)]
    return out.select(*[F.col(f"`{c}`") for c in facts.columns], *[x.alias(c) for c, x in zip(values, found)])


def lookup_join(facts: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str,
                broadcast: bool | int | None = None) -> DataFrame:
    """Left join of ``lookup``, unique on ``lookup_key``, which is left out.

    ``broadcast``: ``None`` measures the lookup against ``MAX_BROADCAST_BYTES``, an
    ``int`` against that many bytes; ``True`` is for a caller who has measured it;
    ``False`` and streams leave the choice to Spark.
    """
    on = F.col(f"`{fact_key}`") == F.col("__key")
    keyed = lookup.withColumnRenamed(lookup_key, "__key")
    if broadcast is True:
        return facts.join(F.broadcast(keyed), on, "left").drop("__key")
    if broadcast is False or facts.isStreaming:
        return facts.join(keyed, on, "left").drop("__key")
    limit = MAX_BROADCAST_BYTES if broadcast is None else int(broadcast)
    if are_small([lookup], limit)[0]:
        return facts.join(F.broadcast(keyed), on, "left").drop("__key")
    return hot_key_join(facts, lookup, fact_key, lookup_key)
