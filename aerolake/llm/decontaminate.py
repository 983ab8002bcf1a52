"""Benchmark decontamination by multi-pattern search after Wu and Manber.

Patterns are windows of ``n`` consecutive words of the benchmark items (a
shorter item is one window). Per pattern length, a shift table over hashed
two-word blocks tells how far the search may jump from a position; blocks
with shift 0 lead, by the hash of a pattern's last block, to the few patterns
that can end there, and these are compared word by word. Every search cursor
of a slice of documents moves in the same numpy step.

Defined cases: a null text has no words; a null or wordless item has no
window; the windows of an item without id are searched, and only its id is
missing among the items found; repeated documents are reported each,
repeated items once; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, materialize, schema, ship

# Letters to lower case, digits and non-ASCII bytes kept, all else a separator.
_KEEP = bytes(c + 32 if 0x41 <= c <= 0x5A else
              c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
              for c in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)
# Text of the items in one search. Its windows and tables take some twenty times as much.
BLOCK_BYTES = 8 << 20
# Comparisons of a window with a pattern done in one numpy step.
_TESTS = 1 << 18


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text."""
    return text.encode().translate(_KEEP).split() if text else []


class Patterns:
    """Search tables for patterns of one length (word ids, 0 is no word)."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        n, self.m = rows.shape
        self.b = min(2, self.m)
        blocks = n * (self.m - self.b + 1)
        self.bits = np.uint64(64 - max(12, (4 * blocks).bit_length()))
        self.far = self.m - self.b + 1
        self.shift = np.full(1 << (64 - int(self.bits)), self.far, np.int8 if self.far < 128 else np.int32)
        ends = range(self.b - 1, self.m)
        for j in ends:
            np.minimum.at(self.shift, self._blocks(rows, j), self.m - 1 - j)
        last = self._blocks(rows, self.m - 1)
        self.order = np.argsort(last, kind="stable")
        self.keys, self.first, self.count = np.unique(last[self.order], return_index=True, return_counts=True)

    def _hash(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        return ((key * _MIX) ^ (key >> np.uint64(29))) * _MIX >> self.bits

    def _blocks(self, rows: np.ndarray, end: int) -> np.ndarray:
        right = rows[:, end]
        return self._hash(rows[:, end - 1] if self.b == 2 else np.zeros_like(right), right)

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end positions, pattern numbers) of all occurrences in ``ids``."""
        m, none = self.m, np.zeros(0, np.int64)
        if len(ids) < m:
            return none, none
        # One cursor for each stretch as long as the widest jump.
        at = np.arange(m - 1, len(ids), self.far)
        stop = np.minimum(at + self.far, len(ids))
        ends = []
        while len(at):
            left = ids[at - 1] if self.b == 2 else np.zeros_like(ids[at])
            jump = self.shift[self._hash(left, ids[at])].astype(np.int64)
            ends.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        end = np.concatenate(ends)
        left = ids[end - 1] if self.b == 2 else np.zeros_like(ids[end])
        key = self._hash(left, ids[end])
        slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        on = (self.keys[slot] == key) & (ids[end] > 0)
        return self._compare(ids, end[on], slot[on])

    def _compare(self, ids, end, slot):
        found, which = [], []
        sizes = self.count[slot]
        edges = np.cumsum(sizes)
        lo = 0
        while lo < len(end):
            done = edges[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(edges, done + _TESTS, side="right")))
            size = sizes[lo:hi]
            cand = np.repeat(np.arange(lo, hi), size)
            step = np.arange(len(cand)) - np.repeat(np.cumsum(size) - size, size)
            pattern = self.order[self.first[slot[cand]] + step]
            begin = end[cand] - self.m + 1
            # Compare one word after the other, keeping only what still fits.
            for j in range(self.m):
                on = ids[begin + j] == self.rows[pattern, j]
                begin, pattern = begin[on], pattern[on]
            found.append(begin + self.m - 1)
            which.append(pattern)
            lo = hi
        none = np.zeros(0, np.int64)
        return np.concatenate(found or [none]), np.concatenate(which or [none])


class Benchmark:
    """All windows of a block of items, by length, with the items they come from."""

    def __init__(self, items: list[tuple[str | None, str]], n: int):
        self.vocab: dict[bytes, int] = {}
        self.names = sorted({i for i, _ in items if i is not None})
        number = {name: k for k, name in enumerate(self.names)}
        flat: list[int] = []
        sizes, owner = [], []
        for item_id, text in items:
            words = words_of(text)
            flat += [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words]
            sizes.append(len(words))
            owner.append(number.get(item_id, -1))
        ids, sizes, owner = np.array(flat, np.int32), np.array(sizes, np.int64), np.array(owner, np.int64)
        begin, length = np.cumsum(sizes) - sizes, np.minimum(sizes, n)
        self.sets = [self._set(ids, begin[length == m], sizes[length == m], owner[length == m], m)
                     for m in np.unique(length[length > 0]).tolist()]

    @staticmethod
    def _set(ids, begin, sizes, owner, m):
        """(patterns, first owner of each, owners): the different windows of ``m`` words."""
        many = sizes - m + 1
        at = np.repeat(begin, many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        rows, owner = ids[at[:, None] + np.arange(m)], np.repeat(owner, many)
        order = np.lexsort((owner, *rows.T[::-1]))
        rows, owner = rows[order], owner[order]
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        window = np.cumsum(fresh) - 1
        named = (owner >= 0) & (fresh | np.append(True, owner[1:] != owner[:-1]))
        first = np.searchsorted(window[named], np.arange(int(fresh.sum()) + 1))
        return Patterns(rows[fresh]), first, owner[named]

    def scan(self, texts: list[str | None]) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
        """Per text: number of words, hit spans (first word, word after the last), items."""
        ids, starts, counts = [], [], []
        get = self.vocab.get
        for text in texts:
            words = words_of(text)
            starts.append(len(ids))
            counts.append(len(words))
            ids.extend([get(w, 0) for w in words])
            ids.append(0)  # no window reaches over the end of a document
        ids, starts = np.array(ids, np.int64), np.array(starts, np.int64)
        change = np.zeros(len(ids) + 1, np.int64)
        items: list[set[str]] = [set() for _ in texts]
        for patterns, first, owners in self.sets:
            end, which = patterns.search(ids)
            np.add.at(change, end - patterns.m + 1, 1)
            np.add.at(change, end + 1, -1)
            doc = np.searchsorted(starts, end, side="right") - 1
            for d, w in {*zip(doc.tolist(), which.tolist())}:
                items[d].update(self.names[k] for k in owners[first[w]:first[w + 1]].tolist())
        hit = np.diff((np.cumsum(change)[:-1] > 0).astype(np.int8), prepend=0, append=0)
        begins, after = np.flatnonzero(hit == 1), np.flatnonzero(hit == -1)
        spans: list[list] = [[] for _ in texts]
        for d, a, b in zip((np.searchsorted(starts, begins, side="right") - 1).tolist(),
                           begins.tolist(), after.tolist()):
            spans[d].append((a - int(starts[d]), b - int(starts[d])))
        return list(zip(counts, spans, items))


def merge_spans(spans) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(s) for s in out]


_SPANS = "array<struct<start:bigint,end:bigint>>"
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def benchmark_hits(docs: DataFrame, items: DataFrame, n: int = 10,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, text, n_words, spans, items``: which words of each document lie
    in a benchmark window, and the ids (as text, sorted) of the items found.

    ``doc_id`` may be of any type. The items travel to the tasks in blocks of about ``block_bytes`` of text,
    one block after the other when there is more than one; no shuffle.
    """
    spark = docs.sparkSession
    items = (items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
             .where("text is not null"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = int(size // block_bytes) + 1
    out = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.lit(0).cast("bigint").alias("n_words"),
                      F.array().cast(_SPANS).alias("spans"), F.array().cast("array<string>").alias("items"))
    fields = schema(out.schema["doc_id"], f"text string, n_words bigint, spans {_SPANS}, items array<string>")
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        tables = ship(spark, Benchmark([tuple(r) for r in part.collect()], n))

        def scan(batch: pa.RecordBatch, tables=tables) -> pa.RecordBatch:
            found = tables().scan(batch.column(1).to_pylist())
            old_spans, old_items = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            spans = [merge_spans([(s["start"], s["end"]) for s in old] + new) if old else new
                     for old, (_, new, _) in zip(old_spans, found)]
            names = [sorted(new | set(old)) for old, (_, _, new) in zip(old_items, found)]
            return pa.record_batch([
                batch.column(0), batch.column(1), pa.array([c for c, _, _ in found], pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], _ARROW_SPANS),
                pa.array(names, pa.list_(pa.string()))], names=batch.schema.names)

        out = arrow_map(out, scan, fields)
        if k < blocks - 1:
            out = materialize(out, "decontaminate")
    return out


def decontamination_report(docs: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """One row per document: word, hit and item counts, digest of the item ids."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, x: s + x["end"] - x["start"])
    return benchmark_hits(docs, items, n).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))
