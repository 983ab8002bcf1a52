import hashlib
import re

from pyspark.sql import functions as F

from aerolake.llm import exact_dedup


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


def written(df, path):
    df.write.parquet(path)
    return path


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "digest").collect()), key=str)


def test_matches_brute_force(spark, make_docs, tricky, tmpdir_str):
    path = written(make_docs(tricky), f"{tmpdir_str}/documents.parquet")
    assert result(exact_dedup.deduplicate(spark, path)) == expected(tricky)


def test_hits_across_batches_and_reruns(spark, make_docs, tricky, tmpdir_str):
    path = written(make_docs(tricky, 4), f"{tmpdir_str}/documents.parquet")
    state = f"{tmpdir_str}/state"
    exact_dedup.ingest(spark, path, state, files_per_batch=1)
    before = sorted(map(str, exact_dedup.read_state(spark, state).collect()))
    exact_dedup.ingest(spark, path, state, files_per_batch=1)  # nothing new: nothing counted twice
    assert sorted(map(str, exact_dedup.read_state(spark, state).collect())) == before
    more = [(0, tricky[0][1]), (50, "new text")]
    make_docs(more, 1).write.mode("append").parquet(path)
    exact_dedup.ingest(spark, path, state)
    first = {r.digest: r for r in exact_dedup.read_state(spark, state).collect()}
    for _, keep, size, _, digest in expected(tricky + more):
        assert (first[digest].doc_id, first[digest].n) == (keep, size)
    assert all(r.file.endswith(".parquet") for r in first.values())
    assert result(exact_dedup.deduplicate(spark, path, state)) == expected(tricky + more)


def test_equal_digests_of_different_texts_are_told_apart(spark, make_docs, tricky, tmpdir_str):
    path = written(make_docs(tricky), f"{tmpdir_str}/documents.parquet")
    weak = lambda text: F.length(text).cast("string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in
                  exact_dedup.deduplicate(spark, path, digest=weak).collect()), key=str)
    assert got == sorted((r[:4] for r in expected(tricky)), key=str)


def test_without_broadcast(spark, make_docs, tricky, tmpdir_str, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_HITS", 0)
    path = written(make_docs(tricky), f"{tmpdir_str}/documents.parquet")
    assert result(exact_dedup.deduplicate(spark, path)) == expected(tricky)


def test_answers_come_from_the_state(spark, make_docs, tricky, tmpdir_str, monkeypatch):
    """Digests that the state holds once are no hits, whatever the texts say."""
    path, state = written(make_docs(tricky), f"{tmpdir_str}/documents.parquet"), f"{tmpdir_str}/state"
    read = exact_dedup.read_state
    monkeypatch.setattr(exact_dedup, "read_state", lambda *a: read(*a).withColumn(
        "n", F.when(F.col("n") > 3, F.col("n")).otherwise(F.lit(1))))
    got = result(exact_dedup.deduplicate(spark, path, state))
    assert got == [r if r[2] > 3 else (r[0], r[0], 1, True, r[4]) for r in expected(tricky)]
    assert any(r[2] > 3 for r in got)


def test_files_removed_after_the_state_saw_them(spark, make_docs, tricky, tmpdir_str):
    path, state = f"{tmpdir_str}/documents.parquet", f"{tmpdir_str}/state"
    make_docs(tricky, 1).write.parquet(path)
    exact_dedup.ingest(spark, path, state)
    fewer = [r for r in tricky if r[0] != 1]
    make_docs(fewer, 2).write.mode("overwrite").parquet(path)
    assert result(exact_dedup.deduplicate(spark, path, state)) == expected(fewer)


def test_hot_text_without_broadcast(spark, make_docs, tmpdir_str, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_HITS", 0)
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i // 2}") for i in range(600)]
    path = written(make_docs(rows), f"{tmpdir_str}/documents.parquet")
    state = f"{tmpdir_str}/state"
    assert result(exact_dedup.deduplicate(spark, path, state)) == expected(rows)
    hits = exact_dedup.read_state(spark, state).where("n > 1")
    assert exact_dedup._heavy(hits, len(rows)) == [hashlib.sha256(b"hot text").hexdigest()]


def test_empty_table(spark, make_docs, tmpdir_str):
    path = written(make_docs([], 1), f"{tmpdir_str}/documents.parquet")
    assert exact_dedup.deduplicate(spark, path).collect() == []


def test_no_python_in_the_plans(spark, make_docs, tricky, tmpdir_str):
    path = written(make_docs(tricky), f"{tmpdir_str}/documents.parquet")
    plan = exact_dedup.deduplicate(spark, path)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
