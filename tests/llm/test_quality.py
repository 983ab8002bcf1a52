import random

import numpy as np

from pyspark.sql import functions as F

from aerolake.llm import quality
from aerolake.llm.common import held_out


def test_tables_and_pairs_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality.Additive.fit(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9
    assert {(i, j) for i, j, _ in model.pairs} >= {(1, 0)}


def test_score_is_a_sum_of_table_entries():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    model = quality.Additive.fit(x, (x[:, 2] > 0).astype(float))
    for row in x[:20]:
        bins = [int(np.searchsorted(e, v, side="right")) for e, v in zip(model.edges, row)]
        f = model.base + sum(t[b] for t, b in zip(model.tables, bins))
        for i, j, t in model.pairs:
            f += t[model._coarse(len(model.tables[i]), len(t))[bins[i]], model._coarse(len(model.tables[j]), len(t))[bins[j]]]
        assert np.isclose(model.score(row[None])[0], 1 / (1 + np.exp(-f)))


def test_held_out_accuracy_and_cases(spark, make_docs):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        good = rng.random() < 0.7
        words = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(5, 60))]
        rows.append((i, " ".join(words if good else (w + "$$$" for w in words))))
        labels.append((i, int(good)))
    rows += [(900, None), (901, ""), (902, "word " * 30000), (902, "word " * 30000), (None, "plain words here")]
    docs = make_docs(rows)
    table = spark.createDataFrame(labels + [(0, None), (None, 1), (1, 0), (1, 1)], "doc_id long, quality int").withColumn("text", F.lit("x"))
    model = quality.fit(docs, table)
    got = quality.score(docs, model).withColumn("held", held_out(F.col("doc_id"))).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    truth = dict(labels)
    test = [(r.score >= 0.7) == bool(truth[r.doc_id]) for r in got if r.held and r.doc_id in truth]
    assert len(test) > 50 and np.mean(test) > 0.97
    # The held-out labels play no part.
    other = table.withColumn("quality", F.when(held_out(F.col("doc_id")), F.lit(0)).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, other)).collect()}
    assert again == {r.doc_id: r.score for r in got}


def test_without_labels_or_documents(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = make_docs([(1, "a"), (2, None)])
    model = quality.fit(docs, none)
    assert [r.score for r in quality.score(docs, model).collect()] == [0.5, 0.5]
    assert quality.score(make_docs([]), model).collect() == []


def test_features_of_odd_texts():
    for text in (None, "", "\x00", "é" * 10, "\n\n\n", "a" * 100000):
        assert len(quality.features(text)) == len(quality.FEATURES) and np.isfinite(quality.features(text)).all()


def plain_steps(x, y, edges, rounds, rate=0.1, lam=2.0):
    """Boosting with trees of two cuts, every cut tried, in plain loops."""
    rows = [[int(np.searchsorted(e, v, side="right")) for e, v in zip(edges, r)] for r in x]
    tables = [[0.0] * (len(e) + 1) for e in edges]
    mean = (sum(y) + 0.5) / (len(y) + 1)
    base = float(np.log(mean / (1 - mean)))

    def leaves(g, h, lo, hi, depth):
        total, weight = sum(g[lo:hi]), sum(h[lo:hi])
        best, at = total ** 2 / (weight + lam) + 1e-9, None
        for c in range(lo + 1, hi):
            gain = sum(g[lo:c]) ** 2 / (sum(h[lo:c]) + lam) + sum(g[c:hi]) ** 2 / (sum(h[c:hi]) + lam)
            if gain > best + 1e-12:
                best, at = gain, c
        if depth and at is not None:
            return leaves(g, h, lo, at, depth - 1) + leaves(g, h, at, hi, depth - 1)
        return [-total / (weight + lam)] * (hi - lo)

    for _ in range(rounds):
        for k, table in enumerate(tables):
            g, h = [0.0] * len(table), [0.0] * len(table)
            for r, target in zip(rows, y):
                p = 1 / (1 + np.exp(-(base + sum(t[b] for t, b in zip(tables, r)))))
                g[r[k]] += p - target
                h[r[k]] += max(p * (1 - p), 1e-6)
            for b, value in enumerate(leaves(g, h, 0, len(table), 2)):
                table[b] += rate * value
    return base, tables


def test_boosting_equals_plain_steps():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 3))
    y = ((x[:, 0] > 0.3) | (np.abs(x[:, 1]) > 1)).astype(float)
    model = quality.Additive.fit(x, y, bins=10, rounds=4, n_pairs=0)
    base, tables = plain_steps(x, y, model.edges, 4)
    assert np.isclose(model.base, base)
    for got, want in zip(model.tables, tables):
        assert np.allclose(got, want)


def test_registered_query(spark, tmp_path, make_docs):
    import zlib

    from aerolake.llm.queries import op7_quality
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(500):
        good = rng.random() < 0.6
        words = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(5, 40))]
        rows.append((i, " ".join(words if good else (w + "$$$" for w in words))))
        # Rows that are held out carry the opposite label: it must not be learned.
        out = zlib.crc32(str(i).encode()) % 4 == 2
        labels.append((i, int(good != out), 0))
    rows += [(None, "no id"), (1000, None), (1001, ""), (5, "another text of five")]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    df = op7_quality(spark, str(tmp_path))
    assert df.columns == ["doc_id", "held_out", "score", "predicted"]
    got = df.collect()
    assert len(got) == len(rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    truth = {i: int("$" not in t) for i, t in rows[:500]}
    right = [int(r.score >= 0.5) == truth[r.doc_id] for r in got if r.doc_id in truth and r.held_out]
    assert len(right) > 80 and sum(right) / len(right) > 0.95


def test_many_texts_of_one_id_stay_bounded(spark, make_docs, monkeypatch):
    docs = make_docs([(1, f"text {k % 300}") for k in range(900)] + [(2, "plain words")])
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    seen = []
    real = quality.Additive.fit
    monkeypatch.setattr(quality.Additive, "fit", classmethod(lambda cls, x, y: seen.append(len(y)) or real(x, y)))
    quality.fit(docs, labels, train_rows=20)
    assert 0 < seen[0] < 60
