"""Text quality by a generalised additive model with pairwise interactions.

Every feature has a lookup table over its quantile bins, and so have a few
pairs of features over coarser bins. Boosting goes round the features in a
cycle: each step fits a shallow tree to the current gradient over one feature's
bins (or one pair's) and adds its leaf values to that table. A score is then
the sum of one table entry per feature and pair, through the logistic function.

Defined cases: a null text counts as empty, an empty text scores from the
features of an empty text; repeated rows score alike; of contradicting
labels for one id the lower counts; with no labelled row every score is 0.5;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, held_out, sampled, schema, ship

FEATURES = ("log_chars", "log_words", "word_length", "long_words", "upper", "digits", "stops", "symbols",
            "non_ascii", "spaces", "distinct_words", "top_word", "repeats", "line_words", "distinct_lines",
            "shouted", "marked", "bare_marks")
_CLASS = np.zeros(256, np.int64)  # 0: other
for _i, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:'\"-?()", b"!#$%&*+/<=>@[\\]^_`{|}~",
                             bytes(range(128, 256)), b" \t\n\r\x0b\x0c"), 1):
    _CLASS[np.frombuffer(_chars, np.uint8)] = _i
_WORDY = bytes(c for c in range(256) if chr(c).isalnum() or c >= 0x80)


def features(text: str | None) -> list[float]:
    """The document's features; whole text, no other column."""
    raw = (text or "").encode()
    kinds = np.bincount(_CLASS, np.bincount(np.frombuffer(raw, np.uint8), minlength=256), 7)
    words = raw.split()
    n, size = max(1, len(words)), max(1, len(raw))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    bag = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    same = sum(map(bytes.__eq__, words[1:], words[:-1]))
    shouted = sum(map(bytes.isupper, words))
    marked = sum(map(raw.count, (b"!! ", b"$$$", b"%%%", b"***", b"###", b"&&&", b" | ")))
    bare = sum(c for w, c in bag.items() if len(w.translate(None, _WORDY)) == len(w))
    return [np.log1p(len(raw)), np.log1p(len(words)), sizes.sum() / n, (sizes > 15).sum() / n,
            *(kinds[1:7] / size), len(bag) / n, (max(bag.values()) if bag else 0) / n, same / n,
            len(words) / max(1, len(lines)), len(set(lines)) / max(1, len(lines)), shouted / n, marked / n, bare / n]


def _split_gain(g, h, lam):
    """Gain of cutting after each position of cumulative gradients, along axis 0."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    return gl * gl / (hl + lam) + gr * gr / (hr + lam)


def _tree(g, h, lam, depth) -> np.ndarray:
    """Leaf value of every bin: a tree of ``depth`` over one feature's bins."""
    if depth and len(g) > 1:
        gain = _split_gain(g, h, lam)
        cut = int(np.argmax(gain)) + 1
        if gain[cut - 1] > g.sum() ** 2 / (h.sum() + lam) + 1e-9:
            return np.concatenate([_tree(g[:cut], h[:cut], lam, depth - 1), _tree(g[cut:], h[cut:], lam, depth - 1)])
    return np.full(len(g), -g.sum() / (h.sum() + lam))


def _pair_tree(g, h, lam) -> np.ndarray:
    """Leaf value of every cell: the best first cut on either axis, then each
    half cut on the other axis."""
    best = None
    for axis in (0, 1):
        a, b = (g, h) if axis == 0 else (g.T, h.T)
        gain = _split_gain(a.sum(1), b.sum(1), lam)
        cut = int(np.argmax(gain)) + 1
        halves = [_tree(a[s].sum(0), b[s].sum(0), lam, 1) for s in (slice(None, cut), slice(cut, None))]
        value = np.vstack([np.tile(halves[0], (cut, 1)), np.tile(halves[1], (len(a) - cut, 1))])
        loss = (value * a).sum() + 0.5 * (value * value * (b + 1e-12)).sum()
        if best is None or loss < best[0]:
            best = (loss, value if axis == 0 else value.T)
    return best[1]


class Additive:
    """The fitted tables; ``score`` only adds table entries."""

    def __init__(self, edges, base, tables, pairs):
        self.edges, self.base, self.tables, self.pairs = edges, base, tables, pairs

    @staticmethod
    def _coarse(bins: int, to: int) -> np.ndarray:
        return np.minimum(np.arange(bins) * to // max(1, bins), to - 1)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 200, n_pairs: int = 6,
            pair_bins: int = 8, pair_rounds: int = 60, rate: float = 0.1, lam: float = 2.0) -> Additive:
        if not len(y):
            return cls([np.zeros(0)] * x.shape[1], 0.0, [np.zeros(1)] * x.shape[1], [])
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        b = [np.searchsorted(e, c, side="right") for e, c in zip(edges, x.T)]
        tables = [np.zeros(len(e) + 1) for e in edges]
        mean = (y.sum() + 0.5) / (len(y) + 1)
        base = float(np.log(mean / (1 - mean)))
        f = np.full(len(y), base)

        def gradient():
            p = 1 / (1 + np.exp(-f))
            return p - y, np.maximum(p * (1 - p), 1e-6)

        for _ in range(rounds):
            for k, table in enumerate(tables):
                g, h = gradient()
                step = rate * _tree(np.bincount(b[k], g, len(table)), np.bincount(b[k], h, len(table)), lam, 2)
                table += step
                f += step[b[k]]
        # The pairs whose cells explain most of what the single tables leave.
        coarse = [cls._coarse(len(t), pair_bins)[bk] for t, bk in zip(tables, b)]
        g, h = gradient()
        gains = []
        for i in range(x.shape[1]):
            for j in range(i):
                cell = coarse[i] * pair_bins + coarse[j]
                gs, hs = np.bincount(cell, g, pair_bins ** 2), np.bincount(cell, h, pair_bins ** 2)
                gains.append(((gs * gs / (hs + lam)).sum(), i, j))
        pairs = [[i, j, np.zeros((pair_bins, pair_bins))] for _, i, j in sorted(gains, reverse=True)[:n_pairs]]
        for _ in range(pair_rounds):
            for i, j, table in pairs:
                g, h = gradient()
                cell = coarse[i] * pair_bins + coarse[j]
                shape = (pair_bins, pair_bins)
                step = rate * _pair_tree(np.bincount(cell, g, table.size).reshape(shape),
                                         np.bincount(cell, h, table.size).reshape(shape), lam)
                table += step
                f += step[coarse[i], coarse[j]]
        return cls(edges, base, tables, [(i, j, t) for i, j, t in pairs])

    def score(self, x: np.ndarray) -> np.ndarray:
        b = [np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T)]
        f = np.full(len(x), self.base)
        for table, bk in zip(self.tables, b):
            f += table[bk]
        for i, j, table in self.pairs:
            to = len(table)
            f += table[self._coarse(len(self.tables[i]), to)[b[i]], self._coarse(len(self.tables[j]), to)[b[j]]]
        return 1 / (1 + np.exp(-f))


def _matrix(texts) -> np.ndarray:
    return np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = 12000) -> Additive:
    """Learn from about ``train_rows`` labelled rows that are not held out,
    chosen by a hash of the id; features are computed on the executors. Equal
    rows count once, and an id's many texts are thinned out by their hash, so
    that the sample stays bounded whatever the ids are."""
    known = (labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
             .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))))
    n = known.count()
    some = known.where(sampled(F.col("doc_id"), min(1.0, train_rows / max(1, n)), "quality")) \
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))

    def extract(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = _matrix(batch.column(0).to_pylist())
        return pa.record_batch([pa.array(list(x), pa.list_(pa.float64())), batch.column(1)], names=["x", "quality"])

    # The labels' number is bounded by train_rows, so they may be broadcast.
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(some), "doc_id").distinct()
    many = texts.count()
    if many > 2 * train_rows:
        texts = texts.where(sampled(F.xxhash64("doc_id", "text"), train_rows / many, "texts"))
    rows = arrow_map(texts.select("text", "quality"), extract, "x array<double>, quality int").toArrow()
    x = np.array(rows["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    y = rows["quality"].to_numpy().astype(float)
    order = np.lexsort([*x.T, y])  # the same model whatever order the rows came in
    return Additive.fit(x[order], y[order])


def score(docs: DataFrame, model: Additive) -> DataFrame:
    """``doc_id, score``: the probability of label 1."""
    tables = ship(docs.sparkSession, model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column(0), pa.array(tables().score(_matrix(batch.column(1).to_pylist())))],
                               names=["doc_id", "score"])

    return arrow_map(docs.select("doc_id", F.col("text").cast("string").alias("text")), run,
                     schema(docs.schema["doc_id"], "score double"))
