"""The pipeline's stages, each against a plain version on its own input."""

import random
import zlib

import duckdb
import numpy as np
import pytest

import corpus_pipeline as cp
from aerolake.llm import language_id
from aerolake.llm.queries import mix_sql, public_tokenizer
from .plain_words import words_of_letters, words_of_spaces
from .test_language_id import TEXTS


def sentence(rng, lang, n):
    return " ".join(rng.choice(TEXTS[lang].split()) + rng.choice(["", "", "s", "en", "er"]) for _ in range(n))


SF001 = "/root/testdata/sf0.001"
ITEM = "the quick answer to this public question is hidden in plain sight"


def corpus():
    rng = random.Random(11)
    rows = []
    for i in range(60):
        lang = rng.choice(["en", "de"])
        rows.append((i, sentence(rng, lang, rng.randint(15, 60)), lang, f"src{i % 5}"))
    rows += [(100 + i, rows[i][1], "en", "src0") for i in range(8)]                         # exact copies
    rows += [(120 + i, rows[i][1] + " also", "en", "src1") for i in range(8, 14)]           # near copies
    rows += [(140, sentence(rng, "en", 20) + " " + ITEM, "en", "src2"), (141, ITEM.upper() + "!", "en", "src2")]
    rows += [(150, None, "en", "src3"), (151, "", None, None), (152, "12 34 !!", "en", "src3"), (153, "the and of", "en", "src3")]
    return rows + [(160, sentence(rng, "de", 40), "de", "src4")] * 2 + [(None, sentence(rng, "en", 30), None, "src4")]


@pytest.fixture
def folder(spark, tmpdir_str):
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{tmpdir_str}/benchmark.parquet")
    return tmpdir_str


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plain_near(rows):
    keep = set()
    sets = {i: frozenset(tuple(w[a:a + 5]) for a in range(max(1, len(w) - 4))) if (w := words_of_spaces(t)) else None for i, t, *_ in rows}
    name = {i: i for i in sets if i is not None}
    changed = True
    while changed:
        changed = False
        for a in name:
            for b in name:
                x, y = sets[a], sets[b]
                if x and y and len(x & y) >= 0.8 * len(x | y) and name[a] > name[b]:
                    name[a], changed = name[b], True
    out, seen = [], set()
    keep = {i for i in name if name[i] == i}
    for r in rows:
        if r[0] is None or r[0] in keep and r[0] not in seen:
            seen.add(r[0])
            out.append(r)
    return out


def test_stages_one_by_one(spark, make_docs, folder):
    docs = make_docs(corpus())
    columns = docs.columns
    start = rows_of(docs)

    kept = cp.keep_languages(spark, docs, folder)
    model = language_id.fit(docs, public_tokenizer("piece_bpe_32k.model"))
    langs, scores = model.predict([r[1] for r in start])
    assert kept.columns == columns
    got = rows_of(kept)
    assert got == sorted((r for r, x, s in zip(start, langs, scores) if x != "und" and s >= cp.LEAST_LANGUAGE), key=str)
    assert {r[0] for r in start} - {r[0] for r in got} == {150, 151, 152}

    kept = cp.keep_one_of_near_duplicates(spark, make_docs([r[:4] for r in got]), folder)
    assert kept.columns == columns
    near = rows_of(kept)
    assert near == sorted(plain_near(got), key=str) and len(near) < len(got) - 8

    kept = cp.drop_benchmark(spark, make_docs([r[:4] for r in near]), folder)
    clean = rows_of(kept)
    item = words_of_letters(ITEM)
    windows = {tuple(item[a:a + 10]) for a in range(len(item) - 9)}
    hit = lambda t: any(tuple(w[a:a + 10]) in windows for w in [words_of_letters(t)] for a in range(len(w)))
    assert kept.columns == columns and clean == [r for r in near if not hit(r[1])]
    assert {140, 141} & {r[0] for r in near} and not {140, 141} & {r[0] for r in clean}

    kept = cp.mix_sources(spark, make_docs([r[:4] for r in clean]), folder)
    mixed = rows_of(kept)
    con = duckdb.connect()
    con.execute("CREATE TABLE d (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?, ?, ?, ?)", [r[:4] for r in clean])
    taken = con.execute("WITH " + mix_sql("d", cp.MIX_SHARE, 1) + " SELECT doc_id FROM mixed WHERE copies > 0").fetchall()
    assert kept.columns == columns and [r[0] for r in mixed] == sorted((t[0] for t in taken), key=str)
    assert all(r in clean for r in mixed)

    out = cp.write_token_files(spark, make_docs([r[:4] for r in mixed]), folder)
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizer("word_bpe_49k.json"))
    start, want = 0, []
    for r in sorted(mixed, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(r[1], add_special_tokens=False).ids + [1]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, out.collect()), key=lambda r: r[1]) == want


def test_run_applies_the_stages(spark):
    out = cp.run(spark, SF001).collect()
    docs = spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert [n for n, _ in cp.STAGES] == ["language_id", "jaccard_join", "decontaminate", "mixing", "token_file"]
    assert 0 < len(out) < docs and len({r.doc_id for r in out}) == len(out)
    ordered = sorted(out, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted(r.doc_id for r in out) and ordered[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:]))


def test_empty_documents(spark, make_docs, folder):
    docs = make_docs([])
    for name, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == make_docs([]).columns, name
    assert cp.write_token_files(spark, docs, folder).collect() == []
