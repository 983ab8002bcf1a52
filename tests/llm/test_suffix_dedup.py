import hashlib
import os
import random
import time

import numpy as np
import pytest

from aerolake.llm import suffix_dedup
from aerolake.llm.queries import op13_suffix_dedup

LATE = suffix_dedup.NO_ID


def expected(rows, n=100):
    """Every window of every document."""
    first, out = {}, []
    data = [(LATE if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in data:
        for a in range(len(t) - n + 1):
            w = t[a:a + n]
            first[w] = min(first.get(w, LATE), i)
    for i, t in data:
        gone, own = np.zeros(len(t), bool), set()
        for a in range(len(t) - n + 1):
            w = t[a:a + n]
            if first[w] < i or w in own:
                gone[a:a + n] = True
            own.add(w)
        edge = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0)).tolist()
        out.append((None if i == LATE else i, len(t), list(zip(edge[::2], edge[1::2])),
                    bytes(np.frombuffer(t, np.uint8)[~gone])))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in df.collect()), key=str)


def test_cover():
    d, v = suffix_dedup.COVER, suffix_dedup.MODULUS
    assert sorted((a - b) % v for a in d for b in d if a != b) == list(range(1, v))


def test_matches_brute_force(make_docs, tricky):
    assert result(suffix_dedup.repeated_bytes(make_docs(tricky))) == expected(tricky)


def passages(seed, n=90):
    """Passages cut at random bytes, periodic texts, ids that repeat or are missing."""
    rng = random.Random(seed)
    letters = ["ab", "abcdefgh ", "aé漢 "][seed % 3]
    pool = ["".join(rng.choice(letters) for _ in range(400)) for _ in range(5)]
    pool.append("".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) * 12)
    rows = []
    for i in rng.sample(range(3 * n), n):
        text = ""
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(pool)
            a = rng.randrange(len(p))
            text += p[a:a + rng.choice([rng.randint(50, 150), rng.randint(95, 105), rng.randint(100, 400)])]
            text += "".join(rng.choice("xyz") for _ in range(rng.choice([0, 1, 30])))
        rows.append((rng.choice([i, i, i, i // 9, None]), text))
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_shared_passages(make_docs, monkeypatch, seed):
    """Documents in many slabs, names in many ranges."""
    monkeypatch.setattr(suffix_dedup, "SLAB", (3000, 3000) if seed % 2 else (1, 1))
    monkeypatch.setattr(suffix_dedup, "RANGE", (2000, 2000))
    rows = passages(seed)
    assert result(suffix_dedup.repeated_bytes(make_docs(rows, 5))) == expected(rows)


def test_registered_query(spark, tmp_path, make_docs):
    rows = passages(11, 150)
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    df = op13_suffix_dedup(spark, str(tmp_path))
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = [(i, n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest()) for i, n, spans, kept in expected(rows)]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


def test_text_is_not_shuffled_again(make_docs, tricky):
    plan = suffix_dedup.repeated_bytes(make_docs(tricky))._jdf.queryExecution().sparkPlan().toString()
    assert "Bucketed: true" in plan


def test_empty_and_short(make_docs):
    assert result(suffix_dedup.repeated_bytes(make_docs([]))) == []
    rows = [(1, None), (2, ""), (3, "a" * 99), (4, "a" * 99)]
    assert result(suffix_dedup.repeated_bytes(make_docs(rows))) == expected(rows)


def test_chance_repeats_end_before_the_windows(make_docs, monkeypatch):
    """Passages of 40 bytes repeat in other surroundings: tuples that occur again, but no window does."""
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcdefghijklmnop") for _ in range(n))
    pool = [text(40) for _ in range(6)]
    rows = [(i, "".join(text(70) + p for p in rng.sample(pool, 6))) for i in range(60)]
    sent, answers = {}, suffix_dedup._answers

    def counting(entries, answer, column):
        sent[column] = entries.selectExpr("coalesce(sum(octet_length(rest)), 0) / 4").first()[0]
        return answers(entries, answer, column)
    monkeypatch.setattr(suffix_dedup, "_answers", counting)
    monkeypatch.setattr(suffix_dedup, "SLAB", (2000, 2000))
    assert result(suffix_dedup.repeated_bytes(make_docs(rows))) == expected(rows)
    assert sent["triples"] > 100 and sent["windows"] == 0


def test_shuffle_files_go_with_their_step(spark, make_docs):
    """Nothing is left for the driver's garbage collection, which may come late."""
    docs = make_docs(passages(4)).localCheckpoint()
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {n for n in blocks.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in n and n.endswith(".data") and os.path.getsize(n) > 1000}
    before, key = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    set_before = spark.conf.get(key, None)
    suffix_dedup.repeated_bytes(docs)
    for _ in range(50):
        if not (left := shuffled() - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(key, None) == set_before
