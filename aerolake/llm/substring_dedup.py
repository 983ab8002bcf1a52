"""Substring deduplication: seed and extend on winnowed anchors.

A repeat is a window of ``WINDOW`` words that also starts in a document with a
smaller id. Of the ``GRAM``-word grams inside a window, the one with the
smallest hash is its anchor, so equal windows choose equal anchors at the same
place, and documents that share a repeat meet at its anchor. An anchor is
extended both ways to its context: all the words of the windows that chose it.

1. Documents are joined on anchor and context. Where a smaller document has
   the same context, every window of it is a repeat.
2. The smallest document of a context may still share some of its windows with
   other contexts of the same anchor: these windows are joined one by one.
3. Adjacent repeats join into maximal ones, and their words are removed.

Only hashes travel, 128 bits to a comparison, built from 64-bit hashes of the
words; positions are found again from the text. So the result is right but for
the chance that two words that differ share a hash, about m * m / 2 ** 65 for m
different words (3e-4 for a hundred million). Within a slice of documents only the smallest document of a context
or window is sent on, the others are repeats already; anchors that a sample
shows in many documents are spread by their contexts. So text shared by a third of
all documents is a row per slice and not per document.

Defined cases: a null text has no words; documents with equal ids do not count
as smaller than each other; a null id is larger than any id; repeated rows are
reported each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import arrow_map, materialize, sampled, ship

WINDOW, GRAM = 13, 6
NO_ID = (1 << 63) - 1
# An anchor in this share of a sample of about SAMPLE_DOCS documents is frequent.
FREQUENT, SAMPLE_DOCS = 0.01, 20_000
_ODD, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_KNOWN = 1 << 18
_OWN, _REPEAT, _SPREAD = 0, 1, 2


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD
    return (h ^ (h >> np.uint64(29))) * _TWO


def _chained(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive values."""
    n = max(0, len(h) - size + 1)
    acc = np.full(n, size, np.uint64)
    for i in range(size):
        acc = _mixed(acc + h[i:n + i])
    return acc


class Runs:
    """The anchors of some texts: document, first and last window, hashes."""

    def __init__(self, texts: list[str | None], known: dict[bytes, int]):
        import xxhash
        digest = xxhash.xxh64_intdigest
        if len(known) > _KNOWN:
            known.clear()
        self.words = [t.encode().split() if t else [] for t in texts]
        flat = []
        for words in self.words:
            for w in words:
                h = known.get(w)
                if h is None:
                    h = known[w] = digest(w)
                flat.append(h)
        h = np.array(flat, np.uint64)
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        doc = np.repeat(np.arange(len(texts)), sizes)
        self.windows = _chained(h, WINDOW)
        grams = _chained(h, GRAM)
        n = len(self.windows)
        order = _mixed(grams)
        best, place = order[:n].copy(), np.zeros(n, np.int64)
        for i in range(1, WINDOW - GRAM + 1):  # the leftmost smallest gram of each window
            less = order[i:n + i] < best
            best[less] = order[i:n + i][less]
            place[less] = i
        at = np.flatnonzero(doc[:n] == doc[WINDOW - 1:]) if n else np.zeros(0, np.int64)
        anchor = at + place[at]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(anchor) != 0) | (np.diff(at) != 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at))[:len(first)] - 1
        self.first, self.last, anchor = at[first], at[last], anchor[first]
        self.doc, self.seed = doc[self.first] if len(first) else first, grams[anchor]
        self.context = _mixed(_mixed(self.windows[self.first] + (anchor - self.first).astype(np.uint64))
                              + self.windows[self.last] * _TWO + (self.last - self.first).astype(np.uint64))

    def spread(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(run, window) of all windows of the chosen runs."""
        size = (self.last - self.first + 1)[chosen]
        run = np.repeat(chosen, size)
        step = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
        return run, self.first[run] + step


def _smallest(key: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (key, id) pairs as row numbers, and which have the key's smallest id."""
    order = np.lexsort((ids, key))
    k, i = key[order], ids[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (k[1:] != k[:-1]) | (i[1:] != i[:-1])
    order, k, i = order[fresh], k[fresh], i[fresh]
    head = np.ones(len(k), bool)
    head[1:] = k[1:] != k[:-1]
    least = i[np.flatnonzero(head)][np.cumsum(head) - 1] if len(k) else i
    return order, i == least


_SCHEMA = "part bigint, kind int, hash bigint, k bigint"


def _rows(part, kind, hashes, ids) -> pa.RecordBatch:
    return pa.record_batch([pa.array(part.view(np.int64)), pa.array(kind.astype(np.int32)),
                            pa.array(hashes.view(np.int64)), pa.array(ids)], names=["part", "kind", "hash", "k"])


def _contexts(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """A row per document and context; ``part`` brings together what must meet."""
    shipped, known = ship(docs.sparkSession, frequent), {}

    def emit(batch: pa.RecordBatch) -> pa.RecordBatch:
        runs = Runs(batch.column(1).to_pylist(), known)
        ids = batch.column(0).to_numpy(zero_copy_only=False)[runs.doc]
        rows, own = _smallest(runs.context, ids)
        seed, context, ids = runs.seed[rows], runs.context[rows], ids[rows]
        many = np.isin(seed, shipped())
        kind = np.where(own, np.where(many, _SPREAD, _OWN), _REPEAT)
        part = np.where(own, np.where(many, _mixed(seed + context), seed), _mixed(context + ids.view(np.uint64)))
        return _rows(part, kind, context, ids)

    return arrow_map(docs, emit, _SCHEMA)


def _frequent(docs: DataFrame) -> np.ndarray:
    """Anchors found in at least ``FREQUENT`` of a sample: at most the anchors of
    a document divided by that share, about ten thousand."""
    n = docs.count()
    some = docs.where(sampled(F.col("k"), min(1.0, SAMPLE_DOCS / max(1, n)), "anchors"))
    known: dict[bytes, int] = {}

    def emit(batch: pa.RecordBatch) -> pa.RecordBatch:
        runs = Runs(batch.column(1).to_pylist(), known)
        seeds, counts = np.unique(np.unique(np.stack([runs.seed, runs.doc.astype(np.uint64)]), axis=1)[0], return_counts=True)
        return pa.record_batch([pa.array(seeds.view(np.int64)), pa.array(counts)], names=["seed", "n"])

    size = min(n, SAMPLE_DOCS)
    rows = arrow_map(some, emit, "seed bigint, n bigint").groupBy("seed").agg(F.sum("n").alias("n")) \
        .where(F.col("n") >= max(16, int(FREQUENT * size))).select("seed").collect()
    return np.array([r[0] for r in rows], np.int64).view(np.uint64)


def _windows(texts: DataFrame) -> DataFrame:
    """A row per document and window of its open contexts."""
    known: dict[bytes, int] = {}

    def emit(batch: pa.RecordBatch) -> pa.RecordBatch:
        runs = Runs(batch.column(1).to_pylist(), known)
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        run, window = runs.spread(_listed(runs.doc, runs.context, batch.column(2)))
        ids, hashes, seeds = ids[runs.doc[run]], runs.windows[window], runs.seed[run]
        rows, own = _smallest(hashes, ids)
        hashes, seeds, ids = hashes[rows], seeds[rows], ids[rows]
        part = np.where(own, _mixed(seeds + hashes), _mixed(hashes + ids.view(np.uint64)))
        return _rows(part, np.where(own, _OWN, _REPEAT), hashes, ids)

    return arrow_map(texts, emit, _SCHEMA)


def _listed(doc: np.ndarray, hashes: np.ndarray, lists: pa.Array) -> np.ndarray:
    """The rows whose hash is in their document's list."""
    sizes = np.diff(lists.offsets.to_numpy()) if lists.null_count == 0 else \
        np.array([len(x) if x is not None else 0 for x in lists.to_pylist()])
    wanted = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    owner = np.repeat(np.arange(len(lists), dtype=np.uint64), sizes)
    mark = lambda d, h: _mixed(h + d * _ODD)
    keys = np.sort(mark(owner, wanted))
    if not len(keys) or not len(hashes):
        return np.zeros(0, np.int64)
    own = mark(doc.astype(np.uint64), hashes)
    slot = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
    return np.flatnonzero(keys[slot] == own)


def repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, spans, kept``: the removed spans of words (first, after
    the last; maximal) and the words that stay, joined by single spaces."""
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("k"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = _contexts(base, _frequent(base)).repartition("part")
    same, anchor = W.partitionBy("part", "hash"), W.partitionBy("part")
    rows = rows.withColumns({"least": F.min("k").over(same), "lo": F.min("hash").over(anchor), "hi": F.max("hash").over(anchor)})
    whole = (F.col("kind") == _REPEAT) | (F.col("k") > F.col("least"))
    shared = (F.col("kind") == _SPREAD) | (F.col("lo") != F.col("hi"))
    found = materialize(rows.where(whole | shared).groupBy("k").agg(
        F.collect_set(F.when(whole, F.col("hash"))).alias("contexts"),
        F.collect_set(F.when(~whole, F.col("hash"))).alias("open")), "repeats")
    texts = base.repartition("k")
    rows = _windows(texts.join(found.select("k", "open").where("size(open) > 0"), "k")).repartition("part")
    rows = rows.withColumn("least", F.min("k").over(same))
    single = rows.where((F.col("kind") == _REPEAT) | (F.col("k") > F.col("least"))) \
        .groupBy("k").agg(F.collect_set("hash").alias("windows"))
    none = F.array().cast("array<bigint>")
    marked = texts.join(found.select("k", "contexts"), "k", "left").join(single, "k", "left").select(
        "k", "text", F.coalesce("contexts", none).alias("contexts"), F.coalesce("windows", none).alias("windows"))
    known: dict[bytes, int] = {}
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def remove(batch: pa.RecordBatch) -> pa.RecordBatch:
        runs = Runs(batch.column(1).to_pylist(), known)
        total = sum(map(len, runs.words))
        change = np.zeros(total + 1, np.int64)
        chosen = _listed(runs.doc, runs.context, batch.column(2))
        np.add.at(change, runs.first[chosen], 1)
        np.add.at(change, runs.last[chosen] + WINDOW, -1)
        run, window = runs.spread(np.arange(len(runs.first)))
        chosen = window[_listed(runs.doc[run], runs.windows[window], batch.column(3))]
        np.add.at(change, chosen, 1)
        np.add.at(change, chosen + WINDOW, -1)
        gone = np.cumsum(change)[:total] > 0
        out = []
        for words, start in zip(runs.words, runs.starts.tolist()):
            mine = gone[start:start + len(words)]
            edge = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0)).tolist()
            spans = list(zip(edge[::2], edge[1::2]))
            kept, at = [], 0
            for a, b in spans:
                kept += words[at:a]
                at = b
            kept += words[at:]
            out.append((len(words), [{"start": a, "end": b} for a, b in spans], b" ".join(kept).decode()))
        return pa.record_batch([batch.column(0), pa.array([o[0] for o in out], pa.int64()),
                                pa.array([o[1] for o in out], spans_type), pa.array([o[2] for o in out], pa.string())],
                               names=["k", "n_words", "spans", "kept"])

    out = arrow_map(marked, remove, "k bigint, n_words bigint, spans array<struct<start:bigint,end:bigint>>, kept string")
    return out.select(F.when(F.col("k") != NO_ID, F.col("k")).alias("doc_id"), "n_words", "spans", "kept")
