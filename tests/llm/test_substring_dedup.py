import random

import pytest

from aerolake.llm import substring_dedup
from .plain_words import words_of_spaces


def expected(rows, n=13):
    first = {}
    key = lambda i: float("inf") if i is None else i
    words = [(i, words_of_spaces(t)) for i, t in rows]
    for i, w in words:
        for a in range(len(w) - n + 1):
            g = tuple(w[a:a + n])
            first[g] = min(first.get(g, key(i)), key(i))
    out = []
    for i, w in words:
        gone = set()
        for a in range(len(w) - n + 1):
            if first[tuple(w[a:a + n])] < key(i):
                gone.update(range(a, a + n))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r.kept) for r in df.collect()), key=str)


def test_matches_brute_force(make_docs, tricky):
    assert result(substring_dedup.repeats(make_docs(tricky))) == expected(tricky)


@pytest.mark.parametrize("seed", range(3))
def test_shared_passages_in_random_order(make_docs, seed, monkeypatch):
    """Few words, many overlaps: passages cut at random places; small slices of text."""
    rng = random.Random(seed)
    pool = [[rng.choice("abcdefgh") for _ in range(40)] for _ in range(6)]
    rows = []
    for i in rng.sample(range(200), 80):
        words = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(pool)
            a = rng.randrange(30)
            words += p[a:a + rng.randint(5, 40)] + [f"w{rng.randrange(500)}"]
        rows.append((i, " ".join(words)))
    if seed == 2:  # all anchors count as frequent
        monkeypatch.setattr(substring_dedup, "FREQUENT", 0.0)
    assert result(substring_dedup.repeats(make_docs(rows, 7))) == expected(rows)


def test_spans_are_maximal(make_docs, tricky):
    for r in substring_dedup.repeats(make_docs(tricky)).collect():
        assert all(s.end - s.start >= substring_dedup.WINDOW for s in r.spans)
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_empty_table(make_docs):
    assert substring_dedup.repeats(make_docs([])).collect() == []
