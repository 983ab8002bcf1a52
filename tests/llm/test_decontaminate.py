import hashlib
import random

from aerolake.llm import decontaminate
from .plain_words import words_of_letters


def expected(rows, items, n=10):
    windows = {}
    for i, t in items:
        w = words_of_letters(t)
        for a in range(max(1, len(w) - n + 1) if w else 0):
            windows.setdefault(tuple(w[a:a + n]), set()).update([str(i)] if i is not None else [])
    out = []
    for i, t in rows:
        w, hit, found = words_of_letters(t), set(), set()
        for m in {len(x) for x in windows}:
            for a in range(len(w) - m + 1):
                owners = windows.get(tuple(w[a:a + m]))
                if owners is not None:
                    hit.update(range(a, a + m))
                    found |= owners
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def items_of(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, spans string")


def cases(seed=1):
    rng = random.Random(seed)
    word = lambda: rng.choice("ab") + rng.choice("cde")
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(None, "ac ad"), (None, "only here without id"), (20, None), (21, " ,.! "), (22, "Rare-Word"), (10, items[3][1]), (10, items[4][1])]
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "x RARE word; y"), (103, " ".join(t for _, t in items if t)), (103, "ac"), (103, "ac"),
             (105, "found only here without id indeed"), (104, "éac\u0000ad Ünï 9")]
    return rows, items


def test_matches_brute_force(spark, make_docs):
    rows, items = cases()
    got = decontaminate.decontamination_report(make_docs(rows), items_of(spark, items)).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, items)


def test_blocks_of_items_give_the_same(spark, make_docs):
    rows, items = cases(2)
    hits = decontaminate.benchmark_hits(make_docs(rows), items_of(spark, items), block_bytes=64).collect()
    got = [(r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r["items"]) for r in hits]
    want = expected(rows, items)
    assert sorted(((i, n, h, len(x), hashlib.sha256(",".join(x).encode()).hexdigest(), h > 0) for i, n, h, x in got), key=str) == want


def test_only_short_or_no_items(spark, make_docs):
    rows, _ = cases(3)
    for items in ([], [(1, None)], [(1, "ac")], [(1, "ac ad"), (2, "ad")]):
        got = decontaminate.decontamination_report(make_docs(rows), items_of(spark, items)).collect()
        assert sorted(map(tuple, got), key=str) == expected(rows, items)


def test_empty_documents(spark, make_docs):
    assert decontaminate.decontamination_report(make_docs([]), items_of(spark, [(1, "a b")])).collect() == []
