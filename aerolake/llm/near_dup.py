"""N-gram Jaccard join with a MinHash LSH forest and exact verification.

A document's set is its shingles of ``n`` consecutive words (a shorter one is
a single shingle). Every tree of the forest labels a set with a sequence of
min-hash values; the labels' prefixes are the nodes of a trie, and two sets meet
at a node if their labels share its prefix. The descent starts at whole labels, and
sets that meet are linked to their node's smallest member. The matched prefix is
then shortened by one value at a time; nodes whose sets are all joined already are
left alone. It ends as soon as the recall, measured on the pairs that met, reaches
``MEASURED_RECALL``, and at the latest where every pair at the threshold meets
with probability ``RECALL``. The connected candidates are verified together: all
their pairs, exactly, tile by tile, with only counts and spanning links leaving a
task.

Equal sets are collapsed first, so copies never form pairs. A tile holds at
most two blocks of ``BLOCK`` sets, and a large group is many tiles.

Defined cases: texts that are null or have no word have no set, link to nothing
and are a class of their own each; repeated rows are copies; an id must not name
different texts; rows with a null id are copies and links like any other, but
their id is skipped as a class name where there is another, and a class without
any id has a null name; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, bound_batches, broadcast_if_small, materialize, release, schema, text_chunks
from .graph import components

TREES, DEPTH, RECALL = 28, 8, 0.9995
# The descent ends above the shortest prefix if this share of the links has met. The
# share is measured on all pairs that met and counts ``PRIOR`` more pairs just at the
# threshold, so that a few close pairs alone don't end it.
MEASURED_RECALL, PRIOR = 0.9998, 1000
BLOCK = 256
_ODD = np.uint64(0x9E3779B97F4A7C15)
_COLUMNS = 1 << 13  # distinct shingles per step of a tile's products


def prefix_length(threshold: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold meets with probability ``recall``."""
    k = depth
    while k > 1 and meeting(threshold, k, trees) < recall:
        k -= 1
    return k


def meeting(similarity: float, k: int, trees: int = TREES) -> float:
    """The probability that two sets meet at a prefix of ``k`` values in some tree."""
    return 1 - (1 - similarity ** k) ** trees


def measured_recall(agreeing: dict[int, float], k: int, threshold: float, prior: float = PRIOR) -> float:
    """The share of links that have met at prefixes of ``k`` values, given how many pairs
    that met agree in how many of all label values.

    Agreement estimates a pair's similarity, and this the probability with which it met:
    a pair that meets with probability p stands for 1/p. Pairs up to two standard errors
    below the threshold count, too.
    """
    values = TREES * DEPTH
    least = threshold - 2 * (threshold * (1 - threshold) / values) ** 0.5
    pairs = [(n, meeting(a / values, k)) for a, n in agreeing.items() if a >= least * values]
    met = sum(n for n, _ in pairs) + prior * meeting(threshold, k)
    return met / (sum(n / p for n, p in pairs) + prior)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD
    return (h ^ (h >> np.uint64(29))) * _ODD


def shingles(texts: list[str | None], n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each text one after the other, ends)."""
    import xxhash
    known: dict[bytes, int] = {}
    digest = xxhash.xxh64_intdigest
    out, ends = [], []
    for text in texts:
        words = text.encode().split() if text else []
        hashes = []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = digest(w)
            hashes.append(h)
        h = np.array(hashes, np.uint64)
        size = min(n, len(h))
        if size:
            acc = np.zeros(len(h) - size + 1, np.uint64)
            for i in range(size):
                acc = _mixed(acc + h[i:len(h) - size + 1 + i])
            h = np.unique(_mixed(acc + np.uint64(size)))
        out.append(h)
        ends.append(len(h))
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.cumsum(ends, dtype=np.int64)


def labels(flat: np.ndarray, ends: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> np.ndarray:
    """16-bit min-hash values, (sets, trees, depth); sets must not be empty."""
    rng = np.random.Generator(np.random.PCG64(20240501))
    odd = rng.integers(1, 1 << 63, trees * depth, dtype=np.uint64) | np.uint64(1)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    out = np.empty((len(ends), trees * depth), ">u2")
    for k, a in enumerate(odd):
        h = flat * a
        low = np.minimum.reduceat(h ^ (h >> np.uint64(32)), starts)
        out[:, k] = (_mixed(low) >> np.uint64(48)).astype(np.uint16)
    return out.reshape(len(ends), trees, depth)


def signatures(docs: DataFrame, n: int = 5) -> DataFrame:
    """``doc_id, digest, labels, spare``: a digest of the shingle set and its label in
    every tree; ``spare`` stands for the missing id of a row without one."""

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, ends = shingles(batch.column(1).to_pylist(), n)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends
        full = np.flatnonzero(ends > starts)
        digests: list[bytes | None] = [None] * batch.num_rows
        marks: list[list[bytes] | None] = [None] * batch.num_rows
        if len(full):
            for i, rows in zip(full.tolist(), labels(flat, ends[full])):
                digests[i] = hashlib.md5(flat[starts[i]:ends[i]].tobytes()).digest()
                marks[i] = [row.tobytes() for row in rows]
        return pa.record_batch([batch.column(0), pa.array(digests, pa.binary()), pa.array(marks, pa.list_(pa.binary())), batch.column(2)],
                               names=["doc_id", "digest", "labels", "spare"])

    text = F.col("text").cast("string")
    return arrow_map(docs.select("doc_id", text.alias("text"), _spare(text).alias("spare")), sign,
                     schema(docs.schema["doc_id"], "digest binary, labels array<binary>, spare string"))


def _spare(text: Column) -> Column:
    return F.when(F.col("doc_id").isNull(), F.sha2(text, 256))


def _meetings(sets: DataFrame, roots: DataFrame | None, k: int) -> DataFrame:
    """``a, b``: the sets at each node of prefixes of ``k`` values, with the node's smallest.

    ``roots`` (``node, root``) names what earlier levels have joined. A node is
    known by a hash of its tree and prefix: equal hashes only add candidates.
    """
    joined = sets.withColumn("root", F.col("node")) if roots is None else sets.join(
        broadcast_if_small(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    nodes = joined.select("node", "root", F.posexplode("labels").alias("tree", "label")).select(
        F.xxhash64("tree", F.substring("label", 1, 2 * k)).alias("at"), "node", "root")
    # Whole labels: every set is its own root.
    ends = [F.min("node").alias("low"), F.max("node").alias("high")] if roots is None \
        else [F.min("root").alias("low"), F.max("root").alias("high")]
    hubs = nodes.groupBy("at").agg(F.min("node").alias("hub"), *ends).where("low < high")
    return nodes.join(hubs.select("at", "hub"), "at").where("node <> hub").select(
        F.col("node").alias("a"), F.col("hub").alias("b")).distinct()


def _agreement(pairs: DataFrame, sets: DataFrame) -> Counter:
    """How many of all the pairs agree in how many label values; only these counts reach
    the driver."""

    def agree(batches):
        for batch in filter(len, batches):
            x, y = (np.frombuffer(b"".join(c.to_pylist()), ">u2").reshape(len(batch), -1) for c in batch.columns)
            yield pa.record_batch([pa.array((x == y).sum(axis=1), pa.int64())], names=["agreeing"])

    bound_batches(pairs.sparkSession)
    pairs = broadcast_if_small(pairs)
    # Labels of a tree stand one after the other: one value a row travels.
    marks = sets.select("node", F.concat(*[F.element_at("labels", t + 1) for t in range(TREES)]).alias("marks"))
    end = lambda c, name: marks.join(pairs, marks["node"] == pairs[c]).select("a", "b", F.col("marks").alias(name))
    both = end("a", "x").join(end("b", "y"), ["a", "b"]).select("x", "y")
    return Counter({r.agreeing: r["count"] for r in
                    both.mapInArrow(agree, "agreeing bigint").groupBy("agreeing").count().collect()})


def _roots(pairs: DataFrame) -> DataFrame:
    """``node, root``: the smallest set that a set met, or that this one met."""
    least = pairs.groupBy("a").agg(F.min("b").alias("b"))
    beyond = least.select(F.col("a").alias("b"), F.col("b").alias("c"))
    return least.join(beyond, "b", "left").select(F.col("a").alias("node"), F.coalesce("c", "b").alias("root"))


def descend(sets: DataFrame, threshold: float) -> tuple[DataFrame, int]:
    """``a, b`` pairs that connect all sets that meet, and the prefix length at which
    the descent of the forest ended. ``sets`` has ``node, labels``."""
    last = prefix_length(threshold)
    pairs, roots, agreeing = None, None, Counter()
    for k in range(DEPTH, last - 1, -1):
        met = materialize(_meetings(sets, roots, k), "meetings")
        pairs = met if pairs is None else pairs.unionByName(met)
        if k > last:
            agreeing += _agreement(met, sets)
            if measured_recall(agreeing, k, threshold) >= MEASURED_RECALL:
                break
            roots = materialize(_roots(pairs), "roots")
    return pairs, k


def verify_tile(left: list[tuple[int, str]], right: list[tuple[int, str]] | None, threshold: float, n: int):
    """Exact links of a tile: (id, number of links here, smallest id it is connected with here).

    Without ``right`` the pairs within ``left`` count, else those between the two.
    """
    rows = left + (right or [])
    flat, ends = shingles([t for _, t in rows], n)
    sizes = np.diff(ends, prepend=0)
    owner = np.repeat(np.arange(len(rows)), sizes)
    _, column = np.unique(flat, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    a, b = (len(rows), len(rows)) if right is None else (len(left), len(right))
    shared = np.zeros((a, b), np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, width, _COLUMNS):
        s, e = np.searchsorted(column, [lo, lo + _COLUMNS])
        has = np.zeros((len(rows), min(_COLUMNS, width - lo)), np.float32)
        has[owner[s:e], column[s:e] - lo] = 1
        shared += has[:a] @ (has.T if right is None else has[a:].T)
    total = sizes[:a, None] + (sizes[None, :] if right is None else sizes[None, a:]) - shared
    linked = (shared >= threshold * total - 1e-6) & (shared > 0)
    if right is None:
        np.fill_diagonal(linked, False)
        links = linked.sum(axis=1)
        x, y = np.nonzero(np.triu(linked))
    else:
        links = np.concatenate([linked.sum(axis=1), linked.sum(axis=0)])
        x, y = np.nonzero(linked)
        y = y + a
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    ids = [r[0] for r in rows]
    for i, j in zip(x.tolist(), y.tolist()):
        i, j = find(i), find(j)
        if i != j:
            parent[max(i, j, key=ids.__getitem__)] = min(i, j, key=ids.__getitem__)
    return [(ids[i], int(links[i]), ids[find(i)]) for i in range(len(rows)) if links[i]]


def _verify(candidates: DataFrame, threshold: float, n: int) -> DataFrame:
    """``node, links, root, tiles`` from ``node, component, size, text``."""
    bound_batches(candidates.sparkSession)
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    tiles = candidates.withColumn("tiles", blocks).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    tiles = tiles.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiles = tiles.select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                         "block", "tiles", "node", "text").repartition("component", "i", "j") \
        .sortWithinPartitions("component", "i", "j", "block", "node")

    def run(batches):
        import pyarrow.compute  # noqa: F401
        out, key, rows, parts = [], None, [], 1

        def close():
            left = [(d, t) for b, d, t in rows if b == key[1]]
            right = None if key[1] == key[2] else [(d, t) for b, d, t in rows if b == key[2]]
            out.extend((*r, parts) for r in verify_tile(left, right, threshold, n))

        def flush():
            names = ["node", "links", "root", "tiles"]
            batch = pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], names=names)
            out.clear()
            return batch

        for chunk in text_chunks(batches):
            for c, i, j, b, p, d, t in zip(*(x.to_pylist() for x in chunk.columns)):
                if (c, i, j) != key and rows:
                    close()
                    rows = []
                key, parts = (c, i, j), p
                if not rows or rows[-1][1] != d:  # repeated rows of one id stand together
                    rows.append((b, d, t))
            if len(out) > 10000:
                yield flush()
        if rows:
            close()
            rows = []
        release()
        if out:
            yield flush()

    return tiles.mapInArrow(run, "node bigint, links bigint, root bigint, tiles bigint")


def jaccard_classes(docs: DataFrame, threshold: float = 0.8, n: int = 5) -> DataFrame:
    """``doc_id, class_id, n_links, n_copies`` of every document.

    ``class_id`` is the smallest id of the class connected by links; ``n_links``
    counts the different sets with Jaccard similarity of at least
    ``threshold``, ``n_copies`` the documents with an equal set (itself too).
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = materialize(signatures(docs, n), "signatures")
    # Sets are numbered, so that those of documents without id take part.
    sets = signed.where("digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.min("spare").alias("spare"), F.count("*").alias("n_copies"), F.first("labels").alias("labels"))
    sets = materialize(sets.withColumn("node", F.monotonically_increasing_id()), "sets")
    pairs, _ = descend(sets, threshold)
    groups = materialize(components(pairs).select(F.col("id").alias("node"), "component"), "candidates")
    sizes = groups.groupBy("component").agg(F.count("*").alias("size"))
    members = materialize(groups.join(sizes, "component").join(sets.select("node", "rep", "spare"), "node"), "candidates")
    with_id = members.where("rep is not null").select("node", "component", "size", F.col("rep").alias("doc_id"))
    texts = docs.join(broadcast_if_small(with_id), "doc_id").select("node", "component", "size", "text")
    without = members.where("rep is null").select("node", "component", "size", "spare")
    if not without.isEmpty():
        # Copies of a text are one before they meet.
        spares = docs.where("doc_id is null").withColumn("spare", _spare(F.col("text"))).join(broadcast_if_small(without), "spare")
        texts = texts.unionByName(spares.groupBy("node", "component", "size").agg(F.min("text").alias("text")))
    found = materialize(_verify(texts, threshold, n), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("n_links"), F.min("root").alias("root"),
                                      F.max("tiles").alias("tiles"))
    # Links inside one tile are complete there; groups of several tiles are joined up.
    spread = found.where("tiles > 1")
    joined = components(spread.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = links.join(joined.withColumnRenamed("id", "node"), "node", "left").join(sets.select("node", "rep"), "node").select(
        "node", "rep", "n_links", F.coalesce("component", "root").alias("class"))
    links = materialize(links, "links")
    names = links.groupBy("class").agg(F.min("rep").alias("class_id"))
    links = links.join(names, "class").select("node", "n_links", "class_id")
    named = sets.select("digest", "node", "rep", "n_copies").join(links, "node", "left").select(
        "digest", F.coalesce("class_id", "rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies")
    return signed.select("doc_id", "digest").join(named, "digest", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"))
