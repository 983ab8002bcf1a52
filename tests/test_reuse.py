"""Stored results: reused for equal plans over equal files, and for nothing else."""

import os
import time

import pytest
from pyspark.sql import functions as F

from aerolake.columns import COLS
from aerolake.lineage import identity, is_stored
from aerolake.operators import FilterSpec
from aerolake.plans import ResultCatalogue, report, testbed
from aerolake.plans.report import REPORT_OUTPUTS
from aerolake.sources import write_clean
from conftest import SF001


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select("id", (F.col("id") % 7).alias("g")).repartition(3).write.parquet(path)
    return path


@pytest.fixture
def store(spark, tmp_path):
    return ResultCatalogue(spark, str(tmp_path / "results"))


def counts(spark, path):
    return spark.read.parquet(path).groupBy("g").agg(F.count("*").alias("n"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_second_time_from_the_store(spark, table, store):
    first, again = store.result(counts(spark, table), "a"), store.result(counts(spark, table), "b")
    assert store.stored == ["a"] and store.hits == ["b"]
    assert rows(first) == rows(again) == rows(counts(spark, table))
    assert "results" in again.inputFiles()[0]
    other = ResultCatalogue(spark, store.root)  # another job
    other.result(counts(spark, table), "c")
    assert other.hits == ["c"]


def test_other_plans_are_other_results(spark, table, store):
    df = spark.read.parquet(table)
    for other in (counts(spark, table).where("n > 142"), counts(spark, table).where("n > 143"),
                  df.groupBy("g").agg(F.count("*").alias("m")), df.select(F.lit(1).alias("x")), df.select(F.lit("1").alias("x")),
                  df.select(*[F.col("id").alias(f"c{k}") for k in range(40)], F.lit(1).alias("z")),
                  df.select(*[F.col("id").alias(f"c{k}") for k in range(40)], F.lit(2).alias("z"))):
        assert rows(store.result(other)) == rows(other)
    assert store.hits == [] and len(store.stored) == 7


@pytest.mark.parametrize("change", ["append", "rewrite", "remove", "touch"])
def test_changed_files_are_never_answered_from_before(spark, table, store, change):
    old = counts(spark, table)  # lists its files now
    store.result(old)
    files = sorted(f for f in os.listdir(table) if f.endswith(".parquet"))
    if change == "append":
        spark.range(1000, 1500).select("id", (F.col("id") % 7).alias("g")).write.mode("append").parquet(table)
    elif change == "rewrite":
        spark.range(500).select("id", F.lit(3).cast("long").alias("g")).write.mode("overwrite").parquet(table)
    elif change == "remove":
        os.remove(f"{table}/{files[0]}")
    else:
        later = time.time() + 5
        os.utime(f"{table}/{files[0]}", (later, later))
    for df in (old, counts(spark, table)):
        assert rows(store.result(df)) == rows(counts(spark, table))
    assert len(store.stored) == 2
    assert store.prune() == 1 and len(store.entries()) == 1
    assert store.lookup(counts(spark, table)) is not None


def test_two_tables_of_one_schema_in_either_order(spark, table, store, tmp_path):
    other = str(tmp_path / "u")
    spark.range(10).select("id", F.lit(1).cast("long").alias("g")).write.parquet(other)
    a, b = spark.read.parquet(table), spark.read.parquet(other)
    for x, y in ((a, b), (b, a)):
        both = x.select(F.col("id").alias("x")).join(y.select(F.col("id").alias("y"), "g"), F.col("x") == F.col("y"), "left")
        assert rows(store.result(both.groupBy("g").count())) == rows(both.groupBy("g").count())
    assert store.hits == []


def test_plans_without_identity_are_not_stored(spark, table, store):
    df = spark.read.parquet(table)
    twice = F.udf(lambda x: x * 2, "long")
    for plan in (df.select(F.rand()), df.select(F.current_timestamp()), df.select(F.current_date()), df.select(F.monotonically_increasing_id()), df.select(twice("id")),
                 df.mapInPandas(lambda it: it, df.schema), spark.createDataFrame([(1,)], "a int").join(df.limit(1)),
                 df.where(df.id > df.agg(F.max(twice("g"))).scalar())):
        assert identity(plan) is None
        assert store.result(plan, "x") is plan
    assert store.stored == [] and len(store.skipped) == 8


def test_subqueries_and_settings_count(spark, table, tmp_path):
    other = str(tmp_path / "limit")
    spark.range(5).write.parquet(other)
    df = spark.read.parquet(table)
    above = lambda: df.where(df.id > spark.read.parquet(other).agg(F.max("id")).scalar())
    before = identity(above())
    assert identity(above()) == before
    spark.range(9).write.mode("append").parquet(other)
    assert identity(above()).plan == before.plan and identity(above()).versions != before.versions
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert identity(above()).plan != before.plan
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_interrupted_write_leaves_no_entry(spark, table, store, monkeypatch):
    import aerolake.plans.catalogue as catalogue

    def stop(*_):
        raise RuntimeError("driver lost")
    monkeypatch.setattr(catalogue, "create_once", stop)
    with pytest.raises(RuntimeError):
        store.result(counts(spark, table))
    monkeypatch.undo()
    assert store.lookup(counts(spark, table)) is None
    assert rows(store.result(counts(spark, table))) == rows(counts(spark, table))
    assert store.prune() == 1  # the data without an entry
    assert store.lookup(counts(spark, table)) is not None


def test_inputs_that_change_during_the_write(spark, table, store, monkeypatch):
    import aerolake.plans.catalogue as catalogue
    calls = []
    real = catalogue.identity

    def changing(df):
        calls.append(1)
        if len(calls) == 2:  # between write and check
            spark.range(5000, 5007).select("id", (F.col("id") % 7).alias("g")).write.mode("append").parquet(table)
        return real(df)
    monkeypatch.setattr(catalogue, "identity", changing)
    assert rows(store.result(counts(spark, table))) == rows(counts(spark, table))
    assert len(store.entries()) == 2 and [e for _, e in store.entries()].count(None) == 1


def test_two_reports_compute_each_output_once(spark, store, tmp_path):
    path = str(tmp_path / "clean")
    write_clean(testbed.clean_flights(spark, SF001), path)
    clean = spark.read.parquet(path)
    spec = FilterSpec(day_start="1995-01-01", day_end="1996-12-31")
    first = report(clean, spec, store=store)
    assert store.hits == [] and set(store.stored) >= set(REPORT_OUTPUTS) - {"rotas"} and store.skipped == []
    assert first["persisted"] == []
    built = len(store.stored)
    second = report(spark.read.parquet(path), spec, store=store)
    assert store.stored[built:] == [] and len(store.hits) == built
    plain = report(clean, spec, persist=False)
    for name in REPORT_OUTPUTS:
        assert rows(first[name]) == rows(second[name]) == rows(plain[name]), name
    # Another filter shares nothing that depends on it.
    report(clean, FilterSpec(day_start="1995-01-01", day_end="1995-06-30"), store=store)
    assert len(store.stored) > built


def test_stored_and_computed_columns(spark, tmp_path):
    path = str(tmp_path / "clean")
    lazy = testbed.clean_flights(spark, SF001)
    write_clean(lazy, path)
    assert not is_stored(lazy, COLS.dep_planned) and is_stored(spark.read.parquet(path), COLS.dep_planned)


def test_lookups_are_measured_once(spark, monkeypatch, tmp_path):
    import aerolake.session as session
    path = str(tmp_path / "lookup")
    spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit("name").alias("v")).write.parquet(path)
    jobs = []
    real = session._in_one_job
    monkeypatch.setattr(session, "_in_one_job", lambda r: jobs.append(len(r)) or real(r))
    for _ in range(3):
        assert session.are_small([spark.read.parquet(path)]) == [True]
    assert jobs == [1, 1]  # rows, then texts
    spark.range(50, 60).select(F.col("id").cast("string").alias("k"), F.lit("name").alias("v")).write.mode("append").parquet(path)
    assert session.are_small([spark.read.parquet(path)]) == [True] and len(jobs) == 4
    assert session.are_small([spark.read.parquet(path)], 500) == [False] and len(jobs) == 5  # the number of rows is enough
