"""Exact quantiles without a map of all values in one task.

The value at a rank is closed in on by histograms: every pass counts the values
of the open intervals in ``BINS`` bins each, with the smallest and largest value
of a bin, and goes on with the bins that hold a wanted rank. A bin of one
value ends the search. Bins follow from arithmetic that is monotone in the
value, so rounding cannot put a value on the wrong side; an interval's ends lie
in different bins, so every pass narrows it. A pass shuffles at most ``BINS`` rows
an interval and task, and the driver gets as many.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096


def values_at(df: DataFrame, x: Column, ranks: Sequence[int]) -> dict[int, float]:
    """The finite values of ``x`` at the given ranks (from 0, ascending)."""
    rows = df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") != float("inf")))
    ends = rows.agg(F.min("x"), F.max("x")).first()
    found: dict[int, float] = {}
    open_ = {(ends[0], ends[1]): (0, sorted(set(ranks)))} if ranks else {}
    while open_:
        for (low, high), (_, wanted) in list(open_.items()):
            if low == high:
                found.update((r, low) for r in wanted)
                del open_[low, high]
        if not open_:
            break
        number, place = F.lit(None).cast("int"), F.lit(None).cast("double")
        spans = sorted(open_)
        for k, (low, high) in enumerate(spans):
            value = F.col("x")
            if math.isinf(high - low):
                value, base, width = value / 2, low / 2, high / 2 - low / 2
            else:
                base, width = low, high - low
            inside = F.col("x").between(F.lit(low), F.lit(high))
            number = F.when(inside, F.lit(k)).otherwise(number)
            place = F.when(inside, F.floor((value - F.lit(base)) / F.lit(width) * BINS).cast("double")).otherwise(place)
        bins = rows.select("x", number.alias("k"), F.least(place, F.lit(float(BINS - 1))).alias("bin")).where("k is not null") \
            .groupBy("k", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()
        after: dict = {}
        for k, span in enumerate(spans):
            before, wanted = open_[span]
            for b in sorted((b for b in bins if b.k == k), key=lambda b: b.bin):
                mine = [r for r in wanted if before <= r < before + b.n]
                if mine:
                    after[b.low, b.high] = (before, mine)
                before += b.n
        open_ = after
    return found


def exact_quantiles(df: DataFrame, column: str | Column, shares: Sequence[float]) -> list[float | None]:
    """The quantiles of a numeric column, nulls left out, interpolated between ranks as
    Spark's ``percentile`` does; NaN counts as the largest value. None without
    values. Reads ``df`` a few times: store it first if it is dear."""
    x = (F.col(f"`{column}`") if isinstance(column, str) else column).cast("double") + F.lit(0.0)  # one zero only
    inf = float("inf")
    when = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    low, finite, high, n = df.select(x.alias("x")).agg(
        when(F.col("x") == -inf), when(~F.isnan("x") & (F.abs("x") != inf)), when(F.col("x") == inf), F.count("x")).first()
    if not n:
        return [None] * len(shares)
    places = [(n - 1) * p for p in shares]
    ranks = {r for p in places for r in (math.floor(p), math.ceil(p))}
    inner = values_at(df, x, [r - low for r in ranks if low <= r < low + finite])

    def at(r: int) -> float:
        if r < low:
            return -inf
        if r < low + finite:
            return inner[r - low]
        return inf if r < low + finite + high else float("nan")

    out = []
    for p in places:
        a, b = math.floor(p), math.ceil(p)
        out.append(at(a) if a == b or at(a) == at(b) else (b - p) * at(a) + (p - a) * at(b))
    return out
