import itertools
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from aerolake.llm import language_id as li
from aerolake.llm.common import held_out
from aerolake.llm.queries import public_tokenizer


def segmentations(word):
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, at = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(word[at:i])
                at = i
        yield parts + [word[at:]]


def brute(word, probs):
    """Sum over all segmentations into pieces; an unknown character is a piece of its own."""
    total = 0.0
    for parts in segmentations(word):
        p = 1.0
        for x in parts:
            p *= probs.get(x, li._UNKNOWN if len(x) == 1 else 0.0)
        total += p
    return total


def test_forward_sums_all_segmentations():
    rng = random.Random(3)
    pieces = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(25)} - {"c"})
    probs = np.array([[rng.random(), rng.random()] for _ in pieces])
    probs /= probs.sum(axis=0)
    vocab = li.Pieces(pieces)
    words = ["a", "abcab", "ccc", "bbbbbbbb", "xay"]
    got = li.word_scores(vocab, probs, words)
    for w, row in zip(words, got):
        for k in range(2):
            assert np.exp(row[k]) == pytest.approx(brute(w, dict(zip(vocab.pieces, probs[:, k]))), rel=1e-9)


def test_expected_counts_are_posterior_uses():
    pieces = ["a", "b", "ab", "ba", "aba"]
    probs = np.array([[0.3], [0.2], [0.25], [0.15], [0.1]])
    vocab = li.Pieces(pieces)
    order = [pieces.index(p) for p in vocab.pieces]
    counts = li.expected_counts(vocab, probs[order], ["abab", "ba"], np.array([2.0, 1.0]))
    want = dict.fromkeys(pieces, 0.0)
    table = {p: float(probs[i, 0]) for i, p in enumerate(pieces)}
    for w, n in (("abab", 2.0), ("ba", 1.0)):
        for parts in segmentations(w):
            p = float(np.prod([table.get(x, 0.0 if len(x) > 1 else li._UNKNOWN) for x in parts]))
            for x in parts:
                if x in want:
                    want[x] += n * p / brute(w, table)
    assert dict(zip(vocab.pieces, counts)) == pytest.approx(want)


def test_long_words_are_cut_and_scored_whole():
    parts = li.pieced("é".encode() * 100)
    assert "".join(parts) == "▁" + "é" * 100 and max(map(len, parts)) <= li._LONG


TEXTS = {"en": "the thing that was then of and with other things", "de": "der die und nicht einer schule gegen bücher"}


def test_queries_documents(spark, make_docs):
    rng = random.Random(1)
    rows = []
    for i in range(120):
        lang = rng.choice(["en", "de"])
        words = TEXTS[lang].split()
        rows.append((i, " ".join(rng.choice(words) for _ in range(12)), lang, "s"))
    rows += [(200, None, "en", "s"), (201, "", "en", "s"), (202, "12 !! 34", "de", "s"), (203, "漢字", None, "s"),
             (None, "the and of", "en", "s"), (204, "UND NICHT " * 4000, None, "s"), (204, "UND NICHT " * 4000, None, "s")]
    docs = make_docs(rows)
    model = li.fit(docs, public_tokenizer("piece_bpe_32k.model"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in li.identify(docs, model).collect()}
    assert all(got[i][0] == lang and 0.5 < got[i][1] <= 1 for i, _, lang, _ in rows[:120])
    assert [got[i][0] for i in (200, 201, 202)] == ["und"] * 3 and got[200][1] == 0
    assert got[203][0] in ("en", "de") and got[None][0] == "en" and got[204][0] == "de"
    # Neither the held-out languages nor the order of rows matter to the model.
    other = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), F.lit("xx")).otherwise(F.col("lang"))).repartition(5)
    again = li.fit(other, public_tokenizer("piece_bpe_32k.model"))
    assert again.langs == model.langs and np.array_equal(again.probs, model.probs)


def test_nothing_to_learn_from(make_docs):
    docs = make_docs([(1, "text", None, None)])
    model = li.fit(docs, public_tokenizer("piece_bpe_32k.model"))
    assert [(r.lang_pred, r.score) for r in li.identify(docs, model).collect()] == [("und", 0.0)]
    assert li.identify(make_docs([]), model).collect() == []
