"""Source divergence audit by one-hot level products.

Within a language, a term's level in a group (a source) is how often it occurs
there. A 0/1 matrix with a row per term and a column per (group, level),
multiplied by its own transpose, holds every joint table at once: at columns
(A, a) and (B, b) the number of terms with level a in A and level b in B. A
pair's divergence is its joint table priced with one value for each pair of
levels, so no term is looked at again for each of the many pairs.

The product is exact and blocked: terms are dealt into slabs, groups into
blocks of ``BLOCK``, and a cell (slab, block, block) is multiplied on its own in
pieces of at most ``COLUMNS`` columns, rare terms first: those share few levels,
so that a piece takes many of them. Level 0 is a column too, for the terms of a
piece; terms that neither block has are priced by their number.

Smoothed shares are in units of 1 / ``UNIT``: ``1 + floor(UNIT (count + 1) / (N + V))``,
all in whole numbers. A term belongs to a language's V terms if at least
``LEAST_DOCS`` of its documents have it.

Defined cases: null text, language and source count as ''; a repeated row is a
document of its own; a group without terms takes part with level 0
throughout; without any term pairs have the value 0; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from aerolake.session import lookup_side

from .common import bound_batches, materialize, release

UNIT, LEAST_DOCS, TOP = 1_000_000_000, 3, 200
# Groups of a block, rows of a slab, columns and entries of a piece's matrix.
BLOCK, SLAB_ROWS, COLUMNS, ENTRIES = 512, 250_000, 2048, 1 << 23
# Entries of a task's dictionaries of counts.
_HELD = 200_000
# Everything but letters and bytes of other scripts parts terms; only A-Z are lowered.
_TERMS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, count, docs``, combined within tasks; a row with a null
    term registers the group."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    bound_batches(docs.sparkSession)

    def packed(counts, present):
        lang, source, term, count, n = [], [], [], [], []
        for (a, b), words in counts.items():
            size = len(words) + 1
            lang += [a] * size
            source += [b] * size
            term.append(None)
            term += words.keys()
            count.append(0)
            count += words.values()
            n.append(0)
            n += map(present[a, b].__getitem__, words)
        return pa.record_batch([pa.array(lang, pa.string()), pa.array(source, pa.string()),
                                pa.array(term, pa.binary()).cast(pa.string()), pa.array(count, pa.int64()),
                                pa.array(n, pa.int64())], names=["lang", "source", "term", "count", "docs"])

    def count(batches):
        counts: dict = {}
        present: dict = {}
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                group = lang, source
                if group not in counts:
                    counts[group], present[group] = Counter(), Counter()
                words = text.encode().translate(_TERMS).split()
                counts[group].update(words)
                present[group].update(set(words))
            if sum(map(len, counts.values())) > _HELD:
                yield packed(counts, present)
                counts.clear()
                present.clear()
                release()
        if counts:
            yield packed(counts, present)

    return rows.mapInArrow(count, "lang string, source string, term string, count bigint, docs bigint")


def kept_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, count, total, first``: the counts of the kept terms,
    their totals in the language, one row of each term marked; a row with a
    null term for every group."""
    term = W.partitionBy("lang", "term")
    counts = term_counts(docs).groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    return counts.withColumns({
        "in_docs": F.sum("docs").over(term), "total": F.sum("count").over(term),
        "first": (F.col("source") == F.min("source").over(term)).cast("long")}) \
        .where(F.col("term").isNull() | (F.col("in_docs") >= LEAST_DOCS)).drop("docs", "in_docs")


def _groups(kept: DataFrame) -> DataFrame:
    """``lang, source, n, v, lang_n, place, blocks``: tokens of a group, kept terms and
    tokens of its language, its place among the language's groups, and the
    number of blocks."""
    lang = W.partitionBy("lang")
    groups = kept.groupBy("lang", "source").agg(
        F.sum("count").alias("n"), F.sum(F.when(F.col("term").isNotNull(), F.col("first")).otherwise(0)).alias("terms"))
    return groups.select(
        "lang", "source", "n", F.sum("terms").over(lang).alias("v"), F.sum("n").over(lang).alias("lang_n"),
        (F.row_number().over(lang.orderBy("source")) - 1).alias("place"),
        F.ceil(F.count("*").over(lang) / BLOCK).cast("int").alias("blocks"))


def share(count: Column, n: Column, v: Column) -> Column:
    """``1 + floor(UNIT (count + 1) / (n + v))`` without leaving 64 bits: the quotient's
    nine decimals, three at a time. Without terms it is 1."""
    whole = F.when(n + v > 0, n + v).otherwise(F.lit(UNIT).cast("long") * 10)
    rest, digits = (count + 1).cast("long"), F.lit(0).cast("long")
    for _ in range(3):
        step = (rest * 1000).cast("long")
        rest = step % whole
        digits = digits * 1000 + F.call_function("div", step, whole)
    return digits + 1


def priced(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def term_report(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """The terms that a source has more of than its language, the first ``TOP``."""
    rows = kept.where("term is not null and count > 0").join(lookup_side(groups), ["lang", "source"]).select(
        "lang", "source", "term", share(F.col("count"), F.col("n"), F.col("v")).alias("p"),
        share(F.col("total"), F.col("lang_n"), F.col("v")).alias("q"))
    rows = rows.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                      priced(F.col("p"), F.col("q")).alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def pair_report(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Every ordered pair of sources of a language with its divergence."""
    slabs = kept.count() // SLAB_ROWS + 1
    block = (F.col("place") / BLOCK).cast("int")
    groups = groups.select("lang", "source", "n", "v", "blocks", block.alias("block"), (F.col("place") % BLOCK).alias("slot"),
                           share(F.lit(0).cast("long"), F.col("n"), F.col("v")).alias("zero"))
    rows = kept.where("term is not null").join(lookup_side(groups), ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), F.lit(slabs)).alias("slab"), "block", "blocks", "slot", F.lit(None).cast("string").alias("source"),
        "total", "term", share(F.col("count"), F.col("n"), F.col("v")).alias("p"), F.lit(0).cast("long").alias("v"))
    heads = groups.select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slabs - 1).cast("long"))).alias("slab"), "block", "blocks", "slot",
        "source", F.lit(-1).cast("long").alias("total"), F.lit(None).cast("string").alias("term"), F.col("zero").alias("p"), "v")
    cells = rows.unionByName(heads).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "lang", "slab", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "slot",
        "total", "term", "p", "v", "source")
    key = ["lang", "slab", "low", "high"]
    cells = cells.repartition(*key).sortWithinPartitions(*key, "total", "term", "block", "slot")
    bound_batches(kept.sparkSession)
    priced_cells = cells.mapInArrow(_price_cells, "lang string, source string, item string, value bigint")
    value = priced_cells.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return value.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))


def _price_cells(batches):
    """Partial values of all pairs of a cell's groups, cell by cell."""
    held, key = [], None
    for batch in batches:
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(4))))
        start = 0
        while start < len(keys):
            stop = start
            while stop < len(keys) and keys[stop] == keys[start]:
                stop += 1
            if held and keys[start] != key:
                yield from _price(key, pa.Table.from_batches(held))
                held = []
            key = keys[start]
            held.append(batch.slice(start, stop - start))
            start = stop
    if held:
        yield from _price(key, pa.Table.from_batches(held))


def _price(key, cell: pa.Table):
    import pyarrow.compute as pc
    lang, slab, low, high = key
    block, slot, p = (cell[c].to_numpy() for c in ("block", "slot", "p"))
    heads = int(pc.sum(pc.is_null(cell["term"])).as_py())  # they come first
    names = cell["source"].slice(0, heads).to_pylist()
    left = np.flatnonzero(block[:heads] == low)
    right = np.flatnonzero(block[:heads] == high)
    v = int(cell["v"][0].as_py())
    number = np.zeros((2, BLOCK), np.int64)  # the head of a group
    number[(block[:heads] == high).astype(int), slot[:heads]] = np.arange(heads)
    group, p_rows, zero = number[(block[heads:] == high).astype(int), slot[heads:]], p[heads:], p[:heads]
    terms = cell["term"].slice(heads).combine_chunks()
    fresh = np.ones(len(terms), bool)
    if len(terms):
        fresh[1:] = pc.not_equal(terms[1:], terms[:-1]).to_numpy(zero_copy_only=False)
    begins = np.append(np.flatnonzero(fresh), len(terms))
    # Values of the first group's terms at the second's shares, and the other way round.
    sides = [(np.zeros((len(a), len(b)), np.int64), a, b) for a, b in ((left, right), (right, left))[:1 if low == high else 2]]
    first = 0
    while first < len(begins) - 1:
        size = max(1, min(ENTRIES // COLUMNS, len(begins) - 1 - first))
        while True:
            a, b = begins[first], begins[first + size]
            levels, level = np.unique(group[a:b] * (UNIT + 2) + p_rows[a:b], return_inverse=True)
            if len(levels) + heads <= COLUMNS or size == 1:
                break
            size //= 2
        _add_piece(sides, zero, levels, level, group[a:b], np.cumsum(fresh[a:b]) - 1, size)
        first += size
    names = np.array(names, object)
    for values, a, b in sides:
        if slab == 0:  # all terms at level 0; the pieces took this off for theirs
            values += v * _prices(zero[a], zero[b])
        source, item = np.repeat(names[a], len(b)), np.tile(names[b], len(a))
        other = np.repeat(a, len(b)) != np.tile(b, len(a))
        yield pa.record_batch([pa.array([lang] * int(other.sum()), pa.string()), pa.array(source[other], pa.string()),
                               pa.array(item[other], pa.string()), pa.array(values.ravel()[other])],
                              names=["lang", "source", "item", "value"])
    release()


def _prices(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p[:, None] - q[None, :]) ** 2 // q[None, :]


def _add_piece(sides, zero, levels, level, group, term, size) -> None:
    """Add the price of a piece's terms, less their price at level 0."""
    heads = len(zero)
    # Columns by group, level 0 first.
    owner = np.concatenate([np.arange(heads), levels // (UNIT + 2)])
    share = np.concatenate([zero, levels % (UNIT + 2)])
    order = np.lexsort((np.arange(len(owner)) >= heads, owner))
    owner, share = owner[order], share[order]
    column = np.empty(len(order), np.int64)
    column[order] = np.arange(len(order))
    onehot = np.zeros((size, len(owner)), np.float32)
    onehot[:, column[:heads]] = 1
    onehot[term, column[group]] = 0
    onehot[term, column[heads + level]] = 1
    for values, rows, columns in sides:
        some, others = np.isin(owner, rows), np.isin(owner, columns)
        joint = (onehot[:, some].T @ onehot[:, others]).astype(np.int64)  # the joint tables
        value = np.add.reduceat(joint * _prices(share[some], share[others]), np.searchsorted(owner[some], rows), axis=0)
        values += np.add.reduceat(value, np.searchsorted(owner[others], columns), axis=1)
        values -= size * _prices(zero[rows], zero[columns])


def divergence_audit(docs: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank``."""
    kept = materialize(kept_counts(docs), "term-counts")
    groups = materialize(_groups(kept), "groups")
    return pair_report(kept, groups).unionByName(term_report(kept, groups))
