import hashlib
import random

import duckdb
import pytest

from pyspark.sql import functions as F

from aerolake.llm import mixing
from aerolake.llm.queries import MIX_WEIGHTS, domain_of, mix_sql
from .plain_words import words_of_spaces


def cases(seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        source = "src0" if rng.random() < 0.35 else f"src{rng.randrange(9)}"
        rows.append((i, " ".join("w" for _ in range(rng.choice([0, 1, 3, 20, 60]))), rng.choice(["en", "en", "de", "fr"]), source))
    return rows + [(500, None, "en", "src0"), (501, "a b", None, None), (502, "a  b\tc", "es", "no number"), (None, "a b", "en", "src1")]


def run(df, **options):
    docs, leaves = mixing.mix(df, domain_of(F.col("source")), MIX_WEIGHTS, **options)
    rows = sorted(((r.row.doc_id, r.domain, r.lang, r.source, r.n_tokens, r.copies) for r in docs.collect()), key=str)
    return rows, {(r.domain, r.lang, r.source): r for r in leaves.collect()}


@pytest.mark.parametrize("share,epochs,bucket", [(0.6, 4, 4096), (0.3, 1, 5), (0.9, 2, 3), (5.0, 2, 4096)])
def test_matches_sql(spark, make_docs, monkeypatch, share, epochs, bucket):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", bucket)
    got, _ = run(make_docs(cases()), share=share, epochs=epochs)
    con = duckdb.connect()
    con.execute("CREATE TABLE d (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?, ?, ?, ?)", cases())
    want = con.execute("WITH " + mix_sql("d", share, epochs) + " SELECT doc_id, domain, lang, source, n_tokens, copies FROM mixed").fetchall()
    assert got == sorted(want, key=str)


def fill(total, nodes):
    """Plain water-filling: shares by weight, again among those that are not full."""
    given, open_ = {}, dict(nodes)
    while open_:
        weight = sum(w for w, _ in open_.values())
        full = {k: c for k, (w, c) in open_.items() if c <= total * w / weight + 1e-9}
        if not full:
            given.update({k: total * w / weight for k, (w, _) in open_.items()})
            break
        for k, c in full.items():
            given[k] = c
            total -= c
            del open_[k]
    return given


def test_budgets_go_to_siblings_before_ancestors(make_docs):
    rows, epochs = cases(2), 2
    _, leaves = run(make_docs(rows), share=0.9, epochs=epochs)
    total = int(sum(len(words_of_spaces(r[1])) for r in rows) * 0.9)
    caps = {leaf: r.tokens * epochs for leaf, r in leaves.items()}
    assert sum(r.budget for r in leaves.values()) == total
    weights, want = MIX_WEIGHTS, {(): total}
    for depth in range(3):
        below = {}
        for path, budget in want.items():
            children = {}
            for leaf, cap in caps.items():
                if leaf[:depth] == path:
                    w, c = children.get(leaf[:depth + 1], (weights[depth].get(leaf[depth], 1), 0))
                    children[leaf[:depth + 1]] = (w, c + cap)
            below.update(fill(budget, children))
        want = below
    for leaf, budget in want.items():
        assert abs(leaves[leaf].budget - budget) <= 4  # whole tokens at three levels


def test_leaf_takes_epochs_and_a_prefix(make_docs):
    got, leaves = run(make_docs(cases(3)), share=0.9, epochs=4)
    for leaf, r in leaves.items():
        docs = [(i, n, c) for i, *where, n, c in got if tuple(where) == leaf]
        whole = min(c for _, _, c in docs)
        assert max(c for _, _, c in docs) <= whole + 1 and (r.tokens == 0 or whole in (r.budget // r.tokens, r.budget // r.tokens + 1))
        taken = sum(n * c for _, n, c in docs)
        assert r.budget <= taken < r.budget + 61 or r.tokens == 0
        if r.tokens and r.budget % r.tokens:
            key = lambda i: hashlib.sha256(f"mix:{r.budget // r.tokens}:{'' if i is None else i}".encode()).hexdigest()
            last = max(key(i) for i, _, c in docs if c > r.budget // r.tokens)
            assert all((key(i) <= last) == (c > r.budget // r.tokens) for i, _, c in docs)


def test_rows_come_back_whole_and_empty_tables(make_docs):
    rows = cases(4)
    docs, _ = mixing.mix(make_docs(rows), domain_of(F.col("source")), MIX_WEIGHTS)
    assert docs.select("row.*").columns == make_docs(rows).columns and docs.count() == len(rows)
    assert run(make_docs([]))[0] == []


def test_no_python_in_the_plan(make_docs):
    plan = mixing.mix(make_docs(cases()), domain_of(F.col("source")), MIX_WEIGHTS)[0]._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
