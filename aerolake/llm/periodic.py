"""Periodic runs of words by a dictionary of basic factors.

A run is a maximal stretch of words with smallest period q and at least
``max(12, 2 q)`` words. The dictionary names the factors of 1, 2, 4, ... words:
equal names at two places mean equal factors. Of the occurrences of a factor
of l words, those that follow each other within l/2 form an arithmetic
progression, whose difference is the factor's own period. Two occurrences
between l and 2 l apart propose that distance as a period:

* both lie in different progressions (else the smaller difference is the period);
* either their progressions' last members, or their first members, or one of them
  and the first or second member of the other are that far apart, because the run
  holds the place where a progression breaks off, or its own middle does.

So a place proposes at most eight periods, found from at most three following
progressions. Proposals of one run are joined, extended both ways by comparing
names from the longest factors down, and of equal stretches the one with the
smallest period stays.

A factor that occurs once gets no name and is left out of longer ones, so the
work falls with every length in ordinary prose. Documents are independent: no
shuffle; the dictionary of a slice holds whole documents, at least one.

Defined cases: a null or empty text has no words and no runs; repeated rows are
reported each; a null id stays null; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, arrow_map, schema

# Least words of a run; a run's proposals start from factors of SHORTEST words.
LEAST, SHORTEST = 12, 4
# Bytes of text in a dictionary; a longer document has one of its own.
_SLICE = 1 << 20
_RUN = "struct<start:bigint,length:bigint,period:bigint>"


def planted(doc_id: Column, text: Column) -> Column:
    """Every tenth document, by the crc32 of its id, with its words made periodic
    from some place on."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"))
    # Numbers once a document in a struct, which the lambda refers to.
    n = F.size(words).cast("long")
    a = g % n
    p = F.lit(1).cast("long") + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
    periodic = F.transform(F.array(F.struct(words.alias("w"), n.alias("n"), a.alias("a"), p.alias("p"))), lambda x: F.array_join(
        F.transform(F.sequence(F.lit(0).cast("long"), x["n"] - 1), lambda i: F.get(
            x["w"], F.when(i < x["a"], i).otherwise(x["a"] + (i - x["a"]) % x["p"]).cast("int"))), " "))[0]
    return F.when((h % 10 == 0) & (n > 0), periodic).otherwise(text)


class Factors:
    """Names of all repeated factors of 2**k words; -1 for the others."""

    def __init__(self, words: np.ndarray):
        """``words``: a number per word, of its own for each document."""
        self.n = n = len(words)
        self.names, self.places = [], []
        at, key, size = np.arange(n), words.astype(np.int64), 1
        while len(at):
            order = np.argsort(key, kind="stable")
            key, at = key[order], at[order]
            fresh = np.ones(len(at), bool)
            fresh[1:] = key[1:] != key[:-1]
            group = np.cumsum(fresh) - 1
            repeated = np.bincount(group)[group] > 1
            at, group = at[repeated], group[repeated]
            if not len(at):
                break
            name = np.full(n + 1, -1, np.int32)
            name[at] = group
            self.names.append(name)
            self.places.append((at, group))
            at = np.sort(at)
            at = at[at + size < n]
            at = at[name[at + size] >= 0]
            key = name[at].astype(np.int64) * (n + 1) + name[at + size]
            size *= 2

    def _proposals(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, period) proposed by the factors of ``2**level`` words."""
        size = 1 << level
        at, group = self.places[level]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (at[1:] - at[:-1] > size // 2)
        series = np.cumsum(fresh) - 1
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(at))[:len(first)] - 1
        second = np.minimum(first + 1, last)
        own = group[first]
        pairs = []
        if size == SHORTEST:  # shorter periods than the factor: next occurrences in a series
            pairs.append((first[second > first], second[second > first]))
        for step in (1, 2, 3):
            ends = np.flatnonzero(own[:-step] == own[step:]) if len(own) > step else np.zeros(0, np.int64)
            follows = np.zeros(len(own), bool)
            follows[ends] = True
            here = np.flatnonzero(follows[series])
            pairs += [(here, first[series[here] + step]), (here, second[series[here] + step]), (last[ends], last[ends + step])]
        i = np.concatenate([at[a] for a, _ in pairs])
        q = np.concatenate([at[b] for _, b in pairs]) - i
        good = (q >= (1 if size == SHORTEST else size)) & (q < 2 * size)
        return _joined(i[good], q[good], size)

    def _right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal words from ``a`` and ``b`` (b > a) on."""
        moved = np.zeros(len(a), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            name = self.names[level]
            x, y = np.minimum(a + moved, self.n), np.minimum(b + moved, self.n)
            moved += ((name[x] == name[y]) & (name[y] >= 0)).astype(np.int64) << level
        return moved

    def _left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal words before ``a`` and ``b``."""
        moved = np.zeros(len(a), np.int64)
        for level in range(len(self.names) - 1, -1, -1):
            name, x = self.names[level], a - moved - (1 << level)
            y = b - moved - (1 << level)
            x = np.where(x < 0, self.n, x)
            moved += ((name[x] == name[y]) & (name[x] >= 0)).astype(np.int64) << level
        return moved

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, period) of all runs, by start, then period."""
        found = [np.zeros((0, 3), np.int64)]
        for level in range(SHORTEST.bit_length() - 1, len(self.names)):
            i, q = self._proposals(level)
            size = 1 << level
            start = i - self._left(i, i + q)
            length = i + q + size + self._right(i + size, i + size + q) - start
            good = length >= np.maximum(LEAST, 2 * q)
            found.append(np.stack([start[good], length[good], q[good]], axis=1))
        start, length, period = np.concatenate(found).T
        order = np.lexsort((period, length, start))
        start, length, period = start[order], length[order], period[order]
        fresh = np.ones(len(start), bool)
        fresh[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
        start, length, period = start[fresh], length[fresh], period[fresh]
        order = np.lexsort((period, start))
        return start[order], length[order], period[order]


def _joined(i: np.ndarray, q: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """One of every chain of proposals of a period at most ``size`` words apart:
    their stretches overlap by a period, so that they lie in one run."""
    order = np.lexsort((i, q))
    i, q = i[order], q[order]
    head = np.ones(len(i), bool)
    head[1:] = (q[1:] != q[:-1]) | (i[1:] - i[:-1] > size)
    return i[head], q[head]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``: the runs by start, then period, and the
    words that no run holds after its first period, joined by single spaces."""
    runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t.encode().split() if t else [] for t in batch.column(1).to_pylist()]
        flat: list[int] = []
        base = 0
        for words in texts:
            known: dict[bytes, int] = {}
            number = known.setdefault
            flat += [number(w, len(known)) + base for w in words]
            base += len(known)
        sizes = np.array([len(w) for w in texts], np.int64)
        begins = np.cumsum(sizes) - sizes
        start, length, period = Factors(np.array(flat, np.int64)).runs()
        change = np.zeros(len(flat) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, start + length, -1)
        gone = np.cumsum(change)[:len(flat)] > 0
        lo, hi = np.searchsorted(start, begins), np.searchsorted(start, begins + sizes)
        runs, kept = [], []
        for words, begin, a, b in zip(texts, begins.tolist(), lo.tolist(), hi.tolist()):
            runs.append([{"start": s - begin, "length": n, "period": q} for s, n, q in
                         zip(start[a:b].tolist(), length[a:b].tolist(), period[a:b].tolist())])
            if a < b:
                stays = np.flatnonzero(~gone[begin:begin + len(words)]).tolist()
                words = [words[i] for i in stays]
            kept.append(b" ".join(words).decode())
        return pa.record_batch([batch.column(0), pa.array(sizes), pa.array(runs, runs_type), pa.array(kept, pa.string())],
                               names=["doc_id", "n_words", "runs", "collapsed"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return arrow_map(rows, judge, schema(rows.schema["doc_id"], f"n_words bigint, runs array<{_RUN}>, collapsed string"),
                     limit=_SLICE)
