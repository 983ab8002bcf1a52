"""Incremental aggregates: equal to a rebuild after any sequence of batches."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from aerolake.columns import COLS, RAW_COLUMNS
from aerolake.operators import FilterSpec
from aerolake.plans import report, testbed
from aerolake.plans.report import REPORT_OUTPUTS
from aerolake.streaming import compact, read_rollups, rollup_report, stream_rollups
from conftest import SF001


@pytest.fixture(scope="module")
def world(spark):
    raw = testbed.raw_flights(spark, SF001).select(*[F.col(f"`{c}`") for c in RAW_COLUMNS]).cache()
    return raw, testbed.airports(spark, SF001), testbed.airlines(spark, SF001)


def extract(raw, folder, k, n):
    """One extract of a share of the flights, as one CSV file."""
    part = raw.where(F.pmod(F.xxhash64(f"`{COLS.flight_number}`"), F.lit(n)) == k)
    part.coalesce(1).write.mode("append").option("header", True).option("sep", ";").option("escape", '"').csv(folder)


def rows(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def assert_equal_to_rebuild(spark, world, store, clean, spec):
    want = report(clean, spec, persist=False)
    got = rollup_report(read_rollups(spark, store).cache(), spec)
    for name in REPORT_OUTPUTS:
        if name != "sample":
            assert got[name].columns == want[name].columns, name
            assert rows(got[name]) == rows(want[name]), name


SPECS = (FilterSpec(), FilterSpec(day_start="1995-03-01", day_end="1996-02-10"), FilterSpec(day_end="1993-05-05"),
         FilterSpec(day_start="2030-01-01"))


def run(spark, world, folder, **more):
    q = stream_rollups(spark, f"{folder}/in", list(RAW_COLUMNS), world[1], world[2], f"{folder}/store", f"{folder}/log",
                       name=f"r{os.path.basename(folder)}", **more)
    q.awaitTermination()


def clean_of(spark, world, folder):
    from aerolake.plans import transform
    from aerolake.sources import read_flights_csv
    return transform(read_flights_csv(spark, f"{folder}/in/part-*"), world[1], world[2])


def test_increments_equal_a_rebuild(spark, world, tmp_path):
    folder = str(tmp_path)
    for k in range(3):
        extract(world[0], f"{folder}/in", k, 5)
    run(spark, world, folder, files_per_batch=1)
    clean = clean_of(spark, world, folder)
    assert_equal_to_rebuild(spark, world, f"{folder}/store", clean, SPECS[1])
    before = rows(read_rollups(spark, f"{folder}/store"))
    run(spark, world, folder)  # nothing new
    assert compact(spark, f"{folder}/store") == 2
    assert rows(read_rollups(spark, f"{folder}/store")) == before
    for k in (3, 4):
        extract(world[0], f"{folder}/in", k, 5)
    run(spark, world, folder)
    clean = clean_of(spark, world, folder).cache()
    for spec in SPECS:
        assert_equal_to_rebuild(spark, world, f"{folder}/store", clean, spec)
    after = rows(read_rollups(spark, f"{folder}/store"))
    assert compact(spark, f"{folder}/store", keep_batches=False) == compact(spark, f"{folder}/store") == 3
    assert rows(read_rollups(spark, f"{folder}/store")) == after
    assert os.listdir(f"{folder}/store/lote") == [] and len(os.listdir(f"{folder}/store/base")) == 1
    clean.unpersist()


@pytest.mark.parametrize("when", ["after the write", "during the write"])
def test_failed_and_repeated_batch_counts_once(spark, world, tmp_path, when):
    folder = str(tmp_path)
    for k in range(3):
        extract(world[0], f"{folder}/in", k, 9)

    def fail(number):
        if number == 1:
            if when == "during the write":
                os.remove(f"{folder}/store/lote/lote-{number:012d}/_SUCCESS")
            raise RuntimeError("driver lost")
    with pytest.raises(StreamingQueryException):
        run(spark, world, folder, files_per_batch=1, after_write=fail)
    run(spark, world, folder, files_per_batch=1)
    clean = clean_of(spark, world, folder)
    assert read_rollups(spark, f"{folder}/store").where("agregado = 'status'").agg(F.sum("n")).first()[0] == clean.count()
    assert_equal_to_rebuild(spark, world, f"{folder}/store", clean, SPECS[0])


def test_a_store_belongs_to_one_stream(spark, world, tmp_path):
    folder = str(tmp_path)
    extract(world[0], f"{folder}/in", 0, 9)
    run(spark, world, folder)
    with pytest.raises(ValueError):
        stream_rollups(spark, f"{folder}/in", list(RAW_COLUMNS), world[1], world[2], f"{folder}/store", f"{folder}/other-log")
    with pytest.raises(ValueError):
        rollup_report(read_rollups(spark, f"{folder}/store"), FilterSpec(airlines=("x",)))


def test_empty_store(spark, tmp_path):
    assert compact(spark, str(tmp_path / "none")) is None
    with pytest.raises(FileNotFoundError):
        read_rollups(spark, str(tmp_path / "none"))


def test_update_and_stored_report_from_the_command_line(spark, world, tmp_path):
    from aerolake.cli import main
    folder = str(tmp_path)
    world[1].coalesce(1).write.json(f"{folder}/airports")
    world[2].agg(F.to_json(F.collect_list(F.struct("Nome", "Sigla"))).alias("value")).write.text(f"{folder}/airlines")
    lookups = ["--airports", f"{folder}/airports", "--airports-fmt", "ndjson", "--airlines", f"{folder}/airlines"]
    days = ["--day-start", "1995-01-01", "--day-end", "1995-12-31"]
    for k in range(2):
        extract(world[0], f"{folder}/in", k, 6)
        assert main(["update", "--csv-folder", f"{folder}/in", "--rollups", f"{folder}/rollups", *lookups, *days,
                     "--out", f"{folder}/increments"], spark) == 0
    assert main(["build", "--clean", f"{folder}/clean", "--csv", f"{folder}/in/part-*", *lookups], spark) == 0
    for _ in range(2):
        assert main(["report", "--clean", f"{folder}/clean", "--out", f"{folder}/report", "--store", f"{folder}/results", *days], spark) == 0
    for name in ("kpis", "per_day", "aeroportos", "rotas"):
        assert rows(spark.read.parquet(f"{folder}/increments/{name}")) == rows(spark.read.parquet(f"{folder}/report/{name}")), name


def test_extracts_grow_in_number_with_the_flights(spark, tmp_path, monkeypatch):
    """The query's extracts hold a bounded number of flights each, and still come in two batches."""
    import __spark_entry__ as entry
    monkeypatch.setattr(entry, "EXTRACT_ROWS", 600, raising=False)
    monkeypatch.setattr(entry, "_folder", lambda spark, name: f"{tmp_path}/{name}")
    got = entry.q_report_incremental(spark, SF001).where("nome = 'kpis'").collect()
    files = [f for f in os.listdir(f"{tmp_path}/rollups/extracts") if f.startswith("part-")]
    assert len(files) > 8 and sorted(os.listdir(f"{tmp_path}/rollups/store/lote")) == [f"lote-{k:012d}" for k in (0, 1)]
    rows_in = [sum(1 for _ in open(f"{tmp_path}/rollups/extracts/{f}", encoding="utf-8")) for f in files]
    assert max(rows_in) < 1500 and len(got) == 1
