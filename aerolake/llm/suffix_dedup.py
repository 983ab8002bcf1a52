"""Suffix-array dedup of byte strings by a distributed difference-cover algorithm.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts earlier.
Of a suffix array over all documents only the groups of suffixes with equal first
``WINDOW`` bytes matter, and their earliest member. They are found as the
difference-cover construction finds them, with modulus v = ``MODULUS`` in place of
the 3 of triples: for any two places in documents some k < v moves both to places
whose remainders are in the cover, and these sampled places have
``WINDOW - v + 1`` bytes within the window.

1. Sampled tuples of that many bytes are sorted and counted; a tuple that occurs
   once is settled, and leaves.
2. The others recurse on longer names, the triple of what may lie before a tuple
   in a window, the tuple, and what may lie behind. Equal triples are equal
   in all windows through the tuple: only the earliest stays.
3. The remaining suffixes are merged through the next sampled place. Where the
   earliest triples of one tuple differ, they can still share some windows. All
   windows of a half, by the tuple's place in them, have ``WINDOW - v / 2`` bytes in
   common: these are sorted and counted as the tuples were, and halves that occur once
   leave. The windows of the others are sorted, and adjacent ones compared.

Sorting is distributed by ranges of names (``bucket``). Names travel as sorted
columns of a slab of documents, one row for a slab and range, and the answers
come back in the same order, so no places are sent. Documents are packed into
slabs, written once, bucketed by slab, and read beside the answers without another
shuffle. A slab sends a name once with its smallest id and count: text
shared by a third of all documents is one entry per slab.

Tuples and halves are compared by 32 bits and the range's; a collision there only sends
more to the next step. Triples and windows are compared by 96 bits of two hashes: the result is
right but for a chance of about m * m / 2 ** 97 for m names, 6e-12 for a billion.

Names grow faster than the text, as more of them repeat by chance; most of those end with
their half. The shuffle files of a step are removed when its answers are written, so
the disk holds the slabs, the answers and one step's names.

Defined cases: a null text has no bytes; rows with equal ids are not earlier than
each other, a null id is later than any id, and rows without id are not
earlier than each other; repeated rows are reported each; other columns are
ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, materialize, release, shared_dir, shuffles_removed, text_chunks

WINDOW = 100
# A cover of all differences modulo 73: each but 0 is met exactly once.
MODULUS, COVER = 73, (0, 1, 12, 20, 26, 30, 33, 35, 57)
NAME = WINDOW - MODULUS + 1
# A tuple's least and largest place in the windows of each half.
HALVES = ((0, MODULUS // 2), (MODULUS // 2 + 1, MODULUS - 1))
NO_ID = (1 << 63) - 1
# Bytes of text in a slab and a range of names: about the square root of all text, between these.
# A worker holds one or the other, with arrays of several times its size.
SLAB, RANGE = (2 << 20, 8 << 20), (4 << 20, 16 << 20)
_ODD, _TWO, _SIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_MANY = 255


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD
    return (h ^ (h >> np.uint64(29))) * _TWO


class Slab:
    """Some documents one after the other, and their sampled places."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, text: bytes):
        self.ids, self.sizes, self.text = ids, sizes, text
        self.begin = np.cumsum(sizes) - sizes
        padded = text + bytes(8)
        self.words = np.ndarray((len(text) + 1,), np.uint64, padded, 0, (1,))  # the eight bytes from each place on
        whole = np.flatnonzero(sizes >= WINDOW)
        at = []
        for r in COVER:
            n = np.maximum(0, -(-(sizes[whole] - NAME + 1 - r) // MODULUS))
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            at.append(np.repeat(self.begin[whole] + r, n) + MODULUS * step)
        self.sampled = np.sort(np.concatenate(at))

    def documents(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, at, "right") - 1

    def hashes(self, at: np.ndarray, size: np.ndarray, second: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes, or the first only, of the ``size`` (at least 8) bytes from ``at`` on."""
        h, g = size.astype(np.uint64), size.astype(np.uint64) * _SIX
        longest, least = (int(size.max()), int(size.min())) if len(size) else (0, 0)
        for i in range(longest // 8):
            some = slice(None) if 8 * (i + 1) <= least else np.flatnonzero(size >= 8 * (i + 1))
            word = self.words[at[some] + 8 * i]
            h[some] = _mixed(h[some] + word)
            if second:
                g[some] = _mixed(g[some] ^ (word * _SIX))
        word = self.words[at + size - 8]
        return _mixed(h + word), _mixed(g ^ (word * _SIX)) if second else g

    def names(self, at: np.ndarray, size: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(distinct names, number of the name of the ``size`` bytes from each ``at`` on, counts)."""
        h, _ = self.hashes(at, size, second=False)
        return np.unique(h >> np.uint64(32 - bits), return_inverse=True, return_counts=True)

    def tuples(self, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The names of the sampled tuples."""
        return self.names(self.sampled, np.full(len(self.sampled), NAME), bits)

    def reach(self, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first and last window through the tuples at ``at``."""
        begin = self.begin[doc]
        return np.maximum(begin, at - MODULUS + 1), np.minimum(at, begin + self.sizes[doc] - WINDOW)


class Names:
    """Equal names of a slab grouped, in order; ``at`` must ascend."""

    def __init__(self, slab: Slab, h: np.ndarray, g: np.ndarray, at: np.ndarray):
        g = g >> np.uint64(32)
        self.order = np.lexsort((g, h))
        h, g = h[self.order], g[self.order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
        self.group = np.cumsum(fresh) - 1
        first = np.flatnonzero(fresh)
        doc = slab.documents(at[self.order])
        self.ids = slab.ids[doc]
        self.again = np.zeros(len(h), bool)  # earlier in the same document, too
        self.again[1:] = ~fresh[1:] & (doc[1:] == doc[:-1])
        self.h, self.g = h[first], g[first].astype(np.uint32)
        self.least = np.minimum.reduceat(self.ids, first) if len(first) else self.ids
        self.count = np.diff(np.append(first, len(h))).astype(np.uint32)

    def repeated(self, elsewhere: np.ndarray) -> np.ndarray:
        """Which occur earlier, given the names that a smaller id has in another slab."""
        out = np.empty(len(self.order), bool)
        out[self.order] = elsewhere[self.group] | self.again | (self.ids > self.least[self.group])
        return out

    def spread(self, values: np.ndarray) -> np.ndarray:
        out = np.empty(len(self.order), values.dtype)
        out[self.order] = values[self.group]
        return out


def _pack(x: np.ndarray) -> bytes:
    """Byte planes: the many equal high bytes compress well."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()


def _unpack(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def _steps(x: np.ndarray) -> bytes:
    return _pack(np.diff(x, prepend=x.dtype.type(0)))


def _unsteps(data: bytes, dtype) -> np.ndarray:
    return np.cumsum(_unpack(data, dtype), dtype=dtype)


_ENTRY = "slab bigint, bucket bigint, names binary, rest binary, ids binary, counts binary"


def _entries(slab: int, bucket: np.ndarray, columns: list[Callable[[slice], bytes]]) -> pa.RecordBatch | None:
    """A row per range of names, given each name's range (ascending)."""
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1)) if len(bucket) else np.zeros(0, np.int64)
    spans = [slice(a, b) for a, b in zip(cuts.tolist(), [*cuts.tolist()[1:], len(bucket)])]
    return pa.record_batch([pa.array([slab] * len(spans), pa.int64()), pa.array(bucket[cuts], pa.int64()),
                            *[pa.array([c(s) for s in spans], pa.binary()) for c in columns]],
                           names=["slab", "bucket", "names", "rest", "ids", "counts"])


def _counted(slab: int, names: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    short = (names & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    empty = lambda s: b""
    return _entries(slab, (names >> np.uint64(32)).astype(np.int64), [
        lambda s: _steps(short[s]), empty, empty, lambda s: _pack(counts[s].astype(np.uint32))])


def _named(slab: int, names: Names, bits: int) -> pa.RecordBatch:
    bucket = (names.h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(names.h), np.int64)
    return _entries(slab, bucket, [lambda s: _steps(names.h[s]), lambda s: _pack(names.g[s]),
                                   lambda s: _pack(names.least[s]), lambda s: _pack(names.count[s])])


def _total(rows: list[dict]) -> list[np.ndarray]:
    """How often each tuple or half occurs in all slabs, up to ``_MANY``."""
    parts = [_unsteps(r["names"], np.uint32) for r in rows]
    names, number = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(number, np.concatenate([_unpack(r["counts"], np.uint32) for r in rows]), len(names))
    return np.split(np.minimum(total, _MANY).astype(np.uint8)[number], np.cumsum([len(p) for p in parts])[:-1])


def _earliest(rows: list[dict]) -> list[np.ndarray]:
    """0 for names that a smaller id has elsewhere, else how often they occur, up to ``_MANY``."""
    parts = [_unsteps(r["names"], np.uint64) for r in rows]
    h, g, ids, count = np.concatenate(parts), *(np.concatenate([_unpack(r[c], t) for r in rows]) for c, t in (
        ("rest", np.uint32), ("ids", np.int64), ("counts", np.uint32)))
    order = np.lexsort((g, h))
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])  # adjacent names
    first, group = np.flatnonzero(fresh), np.cumsum(fresh) - 1
    least, total = np.minimum.reduceat(ids[order], first), np.add.reduceat(count[order].astype(np.int64), first)
    out = np.empty(len(h), np.uint8)
    out[order] = np.where(ids[order] > least[group], 0, np.minimum(total[group], _MANY))
    return np.split(out, np.cumsum([len(p) for p in parts])[:-1])


def _answers(entries: DataFrame, answer: Callable[[list[dict]], list[np.ndarray]], column: str) -> DataFrame:
    """``slab`` and ``column``: an answer byte for each of its names, by ranges."""

    def run(batches: Iterator[pa.RecordBatch]):
        held: list[dict] = []

        def reply():
            out = pa.record_batch([pa.array([r["slab"] for r in held], pa.int64()), pa.array([r["bucket"] for r in held], pa.int64()),
                                   pa.array([x.tobytes() for x in answer(held)], pa.binary())], names=["slab", "bucket", "reply"])
            held.clear()
            release()
            return out
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["bucket"] != row["bucket"]:
                    yield reply()
                held.append(row)
        if held:
            yield reply()

    replies = entries.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "slab bigint, bucket bigint, reply binary")
    with shuffles_removed(entries.sparkSession):
        return materialize(replies.groupBy("slab").agg(F.sort_array(F.collect_list(F.struct("bucket", "reply"))).alias("r"))
                           .select("slab", F.transform("r", lambda x: x["reply"]).alias(column)), column)


def _packed(docs: DataFrame, slab_bytes: int) -> DataFrame:
    """Documents packed into compressed slabs."""
    bound_batches(docs.sparkSession)

    def pack(batches):
        import pyarrow.compute  # noqa: F401
        ids, texts, held = [], [], 0

        def row():
            data = b"".join(texts)
            out = pa.record_batch([
                pa.array([np.concatenate(ids).tobytes()], pa.binary()), pa.array([np.array([len(t) for t in texts], np.int64).tobytes()], pa.binary()),
                pa.array([len(data)], pa.int64()), pa.array([pa.compress(data, codec="zstd", asbytes=True)], pa.binary())],
                names=["ids", "sizes", "n", "text"])
            ids.clear()
            texts.clear()
            release()
            return out
        for batch in text_chunks(batches, limit=slab_bytes):
            part = batch.column(1).to_pylist()
            size = sum(map(len, part))
            if texts and held + size > slab_bytes:
                yield row()
                held = 0
            ids.append(batch.column(0).to_numpy(zero_copy_only=False))
            texts += part
            held += size
        if texts:
            yield row()

    return docs.mapInArrow(pack, "ids binary, sizes binary, n bigint, text binary")


def _stored(slabs: DataFrame, parts: int) -> DataFrame:
    """Slabs written once, bucketed by slab."""
    spark, name = slabs.sparkSession, f"slabs_{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        slabs.withColumn("slab", F.monotonically_increasing_id()).repartition(parts, "slab").write.format("parquet") \
            .option("path", shared_dir(spark, "slabs")).bucketBy(parts, "slab").sortBy("slab").saveAsTable(name)
    return spark.table(name)


def _over(slabs: DataFrame, work: Callable, out: str) -> DataFrame:
    """``work(number, slab, answers)`` for every slab."""
    bound_batches(slabs.sparkSession)
    columns = [c for c in slabs.columns if c in ("tuples", "triples", "halves", "windows")]
    ordered = slabs.select("slab", "ids", "sizes", "n", "text", *columns)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                number, ids, sizes, n, text = (batch.column(c)[i].as_py() for c in range(5))
                answers = [np.frombuffer(b"".join(batch.column(5 + c)[i].as_py() or []), np.uint8) for c in range(len(columns))]
                slab = Slab(np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64),
                            pa.decompress(text, n, codec="zstd", asbytes=True))
                yield work(number, slab, *answers)
                release()
    return ordered.mapInArrow(run, out)


class Found:
    """What the answers say of a slab: its repeated and its open windows."""

    def __init__(self, slab: Slab, bits: int, tuples: np.ndarray):
        _, number, _ = slab.tuples(bits)
        total = tuples[number] if len(number) else np.zeros(0, np.uint8)
        self.slab, self.bits, self.at, self.total = slab, bits, slab.sampled[total > 1], total[total > 1]
        doc = slab.documents(self.at)
        self.first, self.last = slab.reach(self.at, doc)
        h, g = slab.hashes(self.first, self.last + WINDOW - self.first)
        shift = (self.at - self.first).astype(np.uint64)
        self.triples = Names(slab, _mixed(h + shift), _mixed(g + shift), self.at)

    def marks(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The windows from each ``first`` to its ``last``."""
        change = np.zeros(len(self.slab.text) + 1, np.int32)
        np.add.at(change, first, 1)
        np.add.at(change, last + 1, -1)
        return np.cumsum(change, out=change)[:-1] > 0

    def halves(self, triples: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple]:
        """(windows that are repeated, the first and the last of each open half, the names of these)."""
        repeated = self.triples.repeated(triples == 0)
        same = self.triples.spread(triples)
        lone = (same == self.total) & (self.total < _MANY)  # all equal tuples are equal triples
        known = self.marks(self.first[repeated], self.last[repeated])
        unknown = np.zeros(len(known) + 1, np.int32)  # of the windows before each
        np.cumsum(~known, out=unknown[1:])
        some = ~repeated & ~lone
        at, first, last, common, size = self.at[some], [], [], [], []
        for low, high in HALVES:
            a, b = np.maximum(self.first[some], at - high), np.minimum(self.last[some], at - low)
            own = unknown[np.maximum(a, b + 1)] > unknown[a]
            first.append(a[own])
            last.append(b[own])
            common.append(at[own] - low)
            size.append(np.full(len(common[-1]), WINDOW - (high - low)))
        names = self.slab.names(np.concatenate(common), np.concatenate(size), self.bits)
        return known, np.concatenate(first), np.concatenate(last), names

    def windows(self, triples: np.ndarray, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray, Names]:
        """(windows that are repeated, open ones, the names of these)."""
        known, first, last, (_, number, _) = self.halves(triples)
        again = halves[number] > 1
        open_ = np.flatnonzero(self.marks(first[again], last[again]) & ~known)
        return known, open_, Names(self.slab, *self.slab.hashes(open_, np.full(len(open_), WINDOW)), open_)


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: the removed spans of bytes (first, after
    the last; maximal) and the bytes that stay, as binary."""
    spark: SparkSession = docs.sparkSession
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("k"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    root = int((total << 14) ** 0.5)
    slab_bytes, range_bytes = max(SLAB[0], min(SLAB[1], root)), max(RANGE[0], min(RANGE[1], 2 * root))
    bits = min(32, max(0, (total // range_bytes).bit_length()))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (256 << 20))
    slabs = _stored(_packed(base, slab_bytes), parts)

    def tuples(number, slab):
        names, _, counts = slab.tuples(bits)
        return _counted(number, names, counts)

    def triples(number, slab, *answers):
        return _named(number, Found(slab, bits, *answers).triples, bits)

    def halves(number, slab, first, second):
        names, _, counts = Found(slab, bits, first).halves(second)[-1]
        return _counted(number, names, counts)

    def windows(number, slab, first, *answers):
        return _named(number, Found(slab, bits, first).windows(*answers)[2], bits)

    slabs = slabs.join(_answers(_over(slabs, tuples, _ENTRY), _total, "tuples"), "slab", "left")
    slabs = slabs.join(_answers(_over(slabs, triples, _ENTRY), _earliest, "triples"), "slab", "left")
    slabs = slabs.join(_answers(_over(slabs, halves, _ENTRY), _total, "halves"), "slab", "left")
    slabs = slabs.join(_answers(_over(slabs, windows, _ENTRY), _earliest, "windows"), "slab", "left")
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def remove(number, slab, first, *answers):
        *answers, last = answers
        known, open_, names = Found(slab, bits, first).windows(*answers)
        known[open_] = names.repeated(last == 0)
        change = np.zeros(len(slab.text) + WINDOW + 1, np.int32)
        change[:len(known)] += known
        change[WINDOW:WINDOW + len(known)] -= known
        gone = np.cumsum(change, out=change)[:len(slab.text)] > 0
        data = np.frombuffer(slab.text, np.uint8)
        spans, kept = [], []
        for a, n in zip(slab.begin.tolist(), slab.sizes.tolist()):
            mine = gone[a:a + n]
            if not mine.any():
                spans.append([])
                kept.append(slab.text[a:a + n])
                continue
            edge = np.flatnonzero(np.diff(mine.astype(np.int8), prepend=0, append=0)).tolist()
            spans.append([{"start": s, "end": e} for s, e in zip(edge[::2], edge[1::2])])
            kept.append(data[a:a + n][~mine].tobytes())
        return pa.record_batch([pa.array(slab.ids), pa.array(slab.sizes), pa.array(spans, spans_type), pa.array(kept, pa.binary())],
                               names=["k", "n_bytes", "spans", "kept"])

    out = _over(slabs, remove, "k bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
    return out.select(F.when(F.col("k") != NO_ID, F.col("k")).alias("doc_id"), "n_bytes", "spans", "kept")
