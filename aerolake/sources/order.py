"""The first rows of files in the order of the files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def head_in_source_order(df: DataFrame, n: int, keep: Column | None = None) -> DataFrame:
    """The first ``n`` rows of a table of files that pass ``keep``: files by path,
    rows as they stand in a file.

    Only as many files are read as it takes: one, then two more, four more and
    so on until enough rows pass, each look stopping at ``n`` rows. ``df`` must come
    from a file reader, with nothing but column selection done to it.
    """
    path = F.col("_metadata.file_path")
    files = sorted(df.inputFiles())
    taken, step, found = 0, 1, 0
    while taken < len(files) and found < n:
        group = df.where(path.isin(files[taken:taken + step]))
        found += (group if keep is None else group.where(keep)).limit(n - found).count()
        taken, step = taken + step, 2 * step
    part = df.where(path.isin(files[:taken])) if taken < len(files) else df
    part = part if keep is None else part.where(keep)
    place = [F.col("_metadata.file_path").alias("__f"), F.col("_metadata.file_block_start").alias("__b"),
             F.monotonically_increasing_id().alias("__i")]
    return part.select("*", *place).orderBy("__f", "__b", "__i").limit(n).drop("__f", "__b", "__i")
