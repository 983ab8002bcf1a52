import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from aerolake.llm import divergence
from aerolake.llm.queries import op12_divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_audit(rows, least=3, top=200):
    """Every kept term for every pair, in whole numbers."""
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = [w.translate({i: i + 32 for i in range(65, 91)}) for w in TERM.findall(text or "")]
        groups[lang].add(source)
        count[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        total = Counter()
        for s in sources:
            total.update({t: count[lang, s][t] for t in kept})

        def shares(c):
            n = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // n for t in kept}
        of = {s: shares(count[lang, s]) for s in sources}
        own = shares(total)
        for s in sources:
            pair = [(sum((of[s][t] - of[o][t]) ** 2 // of[o][t] for t in kept), o) for o in sources if o != s]
            term = [((of[s][t] - own[t]) ** 2 // own[t], t) for t in kept if count[lang, s][t] and of[s][t] > own[t]]
            for part, found, limit in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(found[:limit])]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def some_rows(seed, n=150, sources=7):
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in "abcdefg" for b in ("x", "é", "漢", "ß", "Q", "")]
    rows = []
    for _ in range(n):
        words = [rng.choice(vocab[:rng.choice([3, 10, 42])]) for _ in range(rng.randint(0, 30))]
        text = rng.choice([" ", ", ", "1", "\n"]).join(words)
        rows.append((rng.choice([text, text.upper(), None, ""][:rng.choice([1, 2, 4])]), rng.choice(["en", "de", None]),
                     rng.choice([None, "", *[f"s{k}" for k in range(sources)]])))
    return rows + [("a a a", "xx", "only"), (None, "yy", "one"), ("12 --", "yy", "two"), ("w " * 5000 + "w", "en", "s1")]


def frame(make_docs, rows):
    return make_docs([(i, *r) for i, r in enumerate(rows)], 4)


@pytest.mark.parametrize("seed,block,columns", [(1, 512, 2048), (2, 3, 8), (3, 1, 2), (4, 2, 30)])
def test_matches_plain_audit(make_docs, monkeypatch, seed, block, columns):
    """Also with groups in many blocks, terms in many slabs and small pieces."""
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "COLUMNS", columns)
    if block < 512:
        monkeypatch.setattr(divergence, "SLAB_ROWS", 60)
        monkeypatch.setattr(divergence, "_HELD", 20)
        monkeypatch.setattr(divergence, "TOP", 5)
    rows = some_rows(seed)
    assert result(divergence.divergence_audit(frame(make_docs, rows))) == plain_audit(rows, top=divergence.TOP)


def test_registered_query(spark, tmp_path, make_docs):
    rows = some_rows(9, sources=3)
    frame(make_docs, rows).write.parquet(f"{tmp_path}/documents.parquet")
    df = op12_divergence(spark, str(tmp_path))
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert isinstance(df.schema["value"].dataType, T.LongType) and isinstance(df.schema["rank"].dataType, T.IntegerType)
    assert result(df) == plain_audit(rows)


def test_share_of_large_counts(spark):
    rows = [(c, n, v) for c in (0, 1, 10 ** 12, 9 * 10 ** 14) for n in (c, c + 1, 9 * 10 ** 14) for v in (1, 7, 10 ** 9)
            if c <= n]
    df = spark.createDataFrame(rows, "c long, n long, v long")
    for r in df.withColumn("p", divergence.share(df.c, df.n, df.v)).collect():
        assert r.p == 1 + 10 ** 9 * (r.c + 1) // (r.n + r.v)


def test_empty_table_and_no_terms(make_docs):
    assert result(divergence.divergence_audit(make_docs([]))) == []
    rows = [("1 2", "en", "a"), ("a", "en", "b"), (None, "en", "a")]
    assert result(divergence.divergence_audit(frame(make_docs, rows))) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
