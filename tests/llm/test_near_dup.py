import numpy as np

from pyspark.sql import functions as F

from aerolake.llm import graph, near_dup
from .plain_words import words_of_spaces


def expected(rows, n=5, threshold=0.8):
    sets = {}
    mine = []
    for i, t in rows:
        w = words_of_spaces(t)
        s = frozenset(tuple(w[a:a + n]) for a in range(max(1, len(w) - n + 1))) if w else None
        mine.append((i, s))
        if s:
            sets.setdefault(s, []).append(i)
    keys = list(sets)
    links = {s: {s} for s in keys}
    for a in keys:
        for b in keys:
            if a != b and len(a & b) >= threshold * len(a | b):
                links[a].add(b)
    name = {}
    for s in keys:
        todo, seen = [s], {s}
        while todo:
            for x in links[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        name[s] = min(i for x in seen for i in sets[x] if i is not None)
    return sorted(((i, name[s], len(links[s]) - 1, len(sets[s])) if s else (i, i, 0, 1) for i, s in mine), key=str)


def test_matches_brute_force(make_docs, tricky):
    rows = [r for r in tricky if r[0] is not None or len(words_of_spaces(r[1])) > 30]
    got = near_dup.jaccard_classes(make_docs(rows)).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_large_group_over_many_tiles(make_docs, tricky, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 3)
    rows = [r for r in tricky if r[0] is not None]
    got = near_dup.jaccard_classes(make_docs(rows)).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows)


def test_rows_without_id_link_like_others(make_docs, monkeypatch):
    """The links and class sizes of a table whose ids are then taken away from some rows."""
    words = [f"w{i}" for i in range(60)]
    near = lambda at, word="x": " ".join([*words[:at], word, *words[at + 1:]])
    other = " ".join(f"v{i}" for i in range(40))
    rows = [(5, near(0)), (None, near(1)), (None, near(1)), (7, near(2)), (None, near(59)),
            (None, other), (None, other + " more"), (None, "alone one two three"), (None, None), (8, "all by itself")]
    want = [(5, 5, 3, 1), (None, 5, 3, 2), (None, 5, 3, 2), (7, 5, 3, 1), (None, 5, 3, 1),
            (None, None, 1, 1), (None, None, 1, 1), (None, None, 0, 1), (None, None, 0, 1), (8, 8, 0, 1)]
    assert sorted(map(tuple, near_dup.jaccard_classes(make_docs(rows)).collect()), key=str) == sorted(want, key=str)
    monkeypatch.setattr(near_dup, "BLOCK", 2)
    assert sorted(map(tuple, near_dup.jaccard_classes(make_docs(rows)).collect()), key=str) == sorted(want, key=str)


def test_lonely_and_empty_tables(make_docs):
    assert near_dup.jaccard_classes(make_docs([])).collect() == []
    assert [tuple(r) for r in near_dup.jaccard_classes(make_docs([(3, "one two")])).collect()] == [(3, 3, 0, 1)]


def test_prefix_is_shortened_until_the_target_recall():
    k = near_dup.prefix_length(0.8)
    recall = lambda k: 1 - (1 - 0.8 ** k) ** near_dup.TREES
    assert recall(k) >= near_dup.RECALL and (k == near_dup.DEPTH or recall(k + 1) < near_dup.RECALL)


def test_descent_ends_where_the_measured_recall_is_met():
    """Against random draws: pairs of given similarities that meet stand for all of them."""
    rng = np.random.default_rng(3)
    values = near_dup.TREES * near_dup.DEPTH
    for similarity, k in [(0.8, 8), (0.85, 8), (0.8, 7), (0.95, 8)]:
        same = rng.random((4000, near_dup.TREES, near_dup.DEPTH)) < similarity
        met = same[:, :, :k].all(axis=2).any(axis=1)
        counts = dict(zip(*np.unique(same[met].sum(axis=(1, 2)), return_counts=True)))
        # Noise of the estimated similarities shows as recall that is too low, never too high.
        assert -0.008 < near_dup.measured_recall(counts, k, 0.5, prior=0) - met.mean() < 0.001
    close = {round(0.95 * values): 100_000}
    assert near_dup.measured_recall(close, 8, 0.8) >= near_dup.MEASURED_RECALL
    assert near_dup.measured_recall({round(0.95 * values): 10}, 8, 0.8) < near_dup.MEASURED_RECALL
    assert near_dup.measured_recall({}, 8, 0.8) < near_dup.MEASURED_RECALL


def _sets(spark, make_docs, rows):
    signed = near_dup.signatures(make_docs(rows).select("doc_id", "text")).where("digest is not null")
    return signed.select(F.col("doc_id").alias("node"), "labels").cache()


def test_descent_joins_all_that_share_a_prefix(spark, make_docs, tricky, monkeypatch):
    """Every level down to the shortest prefix gives the components of its plain form."""
    sets = _sets(spark, make_docs, [r for r in tricky if r[0] is not None])
    labels = {r.node: [bytes(x) for x in r.labels] for r in sets.collect()}
    for ends in (False, True):
        monkeypatch.setattr(near_dup, "measured_recall", lambda *a: float(ends))
        pairs, k = near_dup.descend(sets, 0.8)
        assert k == (near_dup.DEPTH if ends else near_dup.prefix_length(0.8))
        first = {}
        plain = [(i, first.setdefault((t, x[:2 * k]), i)) for i, row in sorted(labels.items()) for t, x in enumerate(row)]
        want = graph.components(spark.createDataFrame(plain, "a long, b long"))
        got = graph.components(pairs)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_joined_nodes_are_left_alone(spark, make_docs):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join([*words[:40 * i], f"x{i}", *words[40 * i + 1:]])) for i in range(8)]
    sets = _sets(spark, make_docs, rows)
    met = near_dup._meetings(sets, None, 8)
    roots = near_dup._roots(met)
    assert {(r.node, r.root) for r in roots.collect()} == {(i, 0) for i in range(1, 8)}
    assert near_dup._meetings(sets, None, 6).count() > 0 and near_dup._meetings(sets, roots, 6).count() == 0


def test_agreement_counts_label_values(spark, make_docs, tricky):
    sets = _sets(spark, make_docs, [r for r in tricky if r[0] in (1, 8, 9, 13)])
    rows = {r.node: np.frombuffer(b"".join(map(bytes, r.labels)), ">u2") for r in sets.collect()}
    pairs = [(8, 1), (9, 1), (13, 9)]
    got = near_dup._agreement(spark.createDataFrame(pairs, "a long, b long"), sets)
    want = {}
    for a, b in pairs:
        same = int((rows[a] == rows[b]).sum())
        want[same] = want.get(same, 0) + 1
    assert got == want


def test_agreement_counts_every_pair(spark, make_docs, monkeypatch):
    """Counts of many pairs are whole, not those of a share of the pairs."""
    monkeypatch.setattr(near_dup, "MEASURED", 20, raising=False)
    words = [f"w{i}" for i in range(300)]
    sets = _sets(spark, make_docs, [(i, " ".join([*words[:i], f"x{i}", *words[i + 1:]])) for i in range(60)])
    rows = {r.node: np.frombuffer(b"".join(map(bytes, r.labels)), ">u2") for r in sets.collect()}
    pairs = [(i, 0) for i in range(1, 60)] + [(i, 1) for i in range(2, 60)]
    want = {}
    for a, b in pairs:
        same = int((rows[a] == rows[b]).sum())
        want[same] = want.get(same, 0) + 1
    assert near_dup._agreement(spark.createDataFrame(pairs, "a long, b long"), sets) == want


def test_labels_agree_like_jaccard():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    b = np.concatenate([a[:800], rng.integers(0, 1 << 63, 100, dtype=np.uint64)])
    x = near_dup.labels(np.concatenate([a, b]), np.array([900, 1800]))
    assert abs((x[0] == x[1]).mean() - 0.8) < 0.12


def test_components(spark):
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 90), (90, 80), (7, 7), (80, 100)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 80, 90: 80, 80: 80}


def test_recall_on_pairs_at_the_threshold(spark, make_docs):
    """Many pairs just above the threshold: all, or nearly all, are found."""
    import random
    rng = random.Random(9)
    rows, pairs = [], 0
    for i in range(0, 240, 2):
        words = [f"w{rng.randrange(10 ** 6)}" for _ in range(120)]
        other = list(words)
        for at in (rng.randrange(5, 50), rng.randrange(60, 115)):  # two edits change ten shingles at most
            other[at] = f"x{rng.randrange(10 ** 6)}"
        rows += [(i, " ".join(words)), (i + 1, " ".join(other))]
    want = [r for r in expected(rows) if r[2]]
    got = {tuple(r) for r in near_dup.jaccard_classes(make_docs(rows)).collect()}
    assert len(want) > 200 and sum(r in got for r in want) >= 0.99 * len(want)
