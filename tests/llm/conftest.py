import random

import pytest

from pyspark.sql import types as T

# Extra columns whose names clash with those the operators use inside.
CLASHES = ("digest", "k", "part", "hash", "rep", "labels", "score", "row", "copies", "domain", "n_tokens", "spans",
           "items", "low", "n", "chunk", "seq")
VOCAB = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau".split()

FIELDS = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
          T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
          T.StructField("n_chars", T.LongType())]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(VOCAB) + rng.choice("aeiou") for _ in range(n))


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text) or (id, text, lang, source) rows, with clashing extra columns."""
    schema = T.StructType(FIELDS + [T.StructField(c, T.StringType()) for c in CLASHES])

    def make(rows, partitions=3):
        full = [(r + ("en", "src1"))[:2] + ((r + ("en", "src1"))[2:4] if len(r) == 2 else r[2:4])
                + (len(r[1] or ""),) + ("x",) * len(CLASHES) for r in rows]
        return spark.createDataFrame(full, schema).repartition(partitions)
    return make


@pytest.fixture
def tricky():
    """Nulls, empty, white space, copies, ties of ids, repeated rows, a very long text."""
    rng = random.Random(7)
    base, passage = prose(rng, 60), prose(rng, 55)
    rows = [(1, base), (2, base), (3, base.replace(" ", "\t\n", 5)), (4, None), (5, ""), (6, "   \n"), (7, "a"), (7, "a"),
            (8, base + " extra"), (9, prose(rng, 30) + " " + passage + " " + prose(rng, 30)),
            (10, passage + " " + prose(rng, 12)), (11, prose(rng, 5) + " " + passage), (12, "so so " * 40),
            (13, prose(rng, 6000)), (14, "Ünïcode é — 漢字 12 !!"), (15, "1234 !!"), (None, base), (None, prose(rng, 20))]
    near = base.split()
    for i in range(20, 32):
        words = list(near)
        words[i % 3] = f"edit{i}"
        rows.append((i, " ".join(words)))
    return rows
