import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolake.llm import periodic
from aerolake.llm.queries import op11_periodic_runs
from .plain_words import words_of_spaces


def plain_runs(words):
    """Every period against every word."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def plain_planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def repetitive(rng):
    letters, out = rng.choice([1, 2, 2, 3, 5]), []
    while len(out) < rng.randint(0, 120):
        part = [rng.randrange(letters) for _ in range(rng.randint(1, 25))]
        out += [part[i % len(part)] for i in range(int(len(part) * rng.choice([1, 2, 2, 2.5, 4])) + rng.randint(0, 2))]
        if rng.random() < 0.3:
            out += out[-rng.randint(1, len(out)):]
        if rng.random() < 0.2:
            half = ([0, 1] * rng.randint(1, 20))[:-1]
            out += half + half
    return out


@pytest.mark.parametrize("seed", range(4))
def test_all_runs_of_random_words(seed):
    rng = random.Random(seed)
    for _ in range(400):
        words = repetitive(rng)
        got = list(zip(*(x.tolist() for x in periodic.Factors(np.array(words, np.int64)).runs())))
        assert got == sorted(plain_runs(words), key=lambda r: (r[0], r[2])), words


def test_squares_around_one_place():
    """Every odd period has a run of just two periods around the middle."""
    words = [0, 1] * 30 + [0, 0] + [1, 0] * 30
    got = list(zip(*(x.tolist() for x in periodic.Factors(np.array(words, np.int64)).runs())))
    assert got == sorted(plain_runs(words), key=lambda r: (r[0], r[2])) and len(got) > 20


def test_documents_are_apart(make_docs, tricky):
    rows = tricky + [(40, "x " * 30), (41, "x " * 30 + "y"), (42, " ".join("abc" * 9))]
    got = {}
    for r in periodic.periodic_runs(make_docs(rows, 2)).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    for i, text in rows:
        words = words_of_spaces(text)
        runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
        assert (len(words), runs, collapsed(words, runs)) in got[i]
    assert sum(map(len, got.values())) == len(rows)


def test_registered_query(spark, tmp_path, make_docs, tricky):
    rng = random.Random(3)
    rows = tricky + [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 70)))) for i in range(100, 400)]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, text in rows:
        words = plain_planted(i, words_of_spaces(text))
        runs = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((i, len(runs), *best, best[1] and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(),
                     hashlib.sha256(collapsed(words, runs).encode()).hexdigest()))
    got = [tuple(r) for r in op11_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table_and_id_type(make_docs):
    assert periodic.periodic_runs(make_docs([])).collect() == []
    docs = make_docs([(1, "a b")]).withColumn("doc_id", F.lit("one"))
    assert [tuple(r) for r in periodic.periodic_runs(docs).collect()] == [("one", 2, [], "a b")]
