"""Paths for large data: hot keys, quantiles by ranks, files with line breaks, first rows, clustering."""

import csv
import glob
import json
import math
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from aerolake.columns import COLS
from aerolake.operators import FilterSpec, apply_filters, enrich_airline, enrich_airports
from aerolake.operators.hotkeys import heavy_keys, hot_key_join, lookup_join
from aerolake.operators.quantiles import exact_quantiles
from aerolake.plans import testbed
from aerolake.sources import csv_to_ndjson, head_in_source_order, read_csv, read_flights_csv, write_clean
from conftest import ROOT, SF001


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---------------------------------------------------------------- hot keys
def hot_facts(spark, n=60_000):
    """A third of the rows on one key, a sixth without a key."""
    k = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 6 == 1, F.lit(None)).otherwise((F.col("id") % 997).cast("string"))
    return spark.range(n).select("id", k.alias("k"))


def lookup(spark):
    return spark.range(900).select(F.col("id").cast("string").alias("key"), F.concat(F.lit("n"), "id").alias("name")) \
        .unionByName(spark.createDataFrame([("hot", "HOT")], "key string, name string"))


def test_hot_key_join_equals_broadcast(spark):
    facts, dim = hot_facts(spark), lookup(spark)
    assert heavy_keys(facts, F.col("k")) == ["hot"]
    want = rows(lookup_join(facts, dim, "k", "key", True))
    assert rows(lookup_join(facts, dim, "k", "key", 0)) == want
    assert rows(hot_key_join(facts, dim, "k", "key", heavy=[])) == want
    assert rows(hot_key_join(facts, dim, "k", "key", heavy=["hot", "5", "unknown"])) == want
    without = dim.where("key <> 'hot'")
    assert rows(lookup_join(facts, without, "k", "key", 0)) == rows(lookup_join(facts, without, "k", "key", True))


def test_enrichments_over_large_lookups(spark):
    raw = testbed.raw_flights(spark, SF001).withColumn(
        COLS.airline_icao, F.when(F.substring(F.col(f"`{COLS.flight_number}`"), 4, 20).cast("long") % 3 == 0, "1")
        .otherwise(F.col(f"`{COLS.airline_icao}`")))
    airports, airlines = testbed.airports(spark, SF001), testbed.airlines(spark, SF001)
    assert rows(enrich_airline(raw, airlines, broadcast=0)) == rows(enrich_airline(raw, airlines))
    a, b = enrich_airports(raw, airports, broadcast=0), enrich_airports(raw, airports)
    assert a.columns == b.columns and rows(a) == rows(b)


_SKEW = """
import glob, json, sys
sys.path[:0] = [{root!r}, {root!r} + "/tests"]
from pyspark.sql import functions as F
from aerolake.session import build_session
spark = build_session("local[4]", shuffle_partitions=16, extra={{
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": {log!r}, "spark.eventLog.compress": "false",
    "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}})
from test_scale_paths import hot_facts, lookup
from aerolake.operators.hotkeys import lookup_join
facts, dim = hot_facts(spark, 400_000), lookup(spark)
plain, way = lookup_join(facts, dim, "k", "key", False), lookup_join(facts, dim, "k", "key", 0)
for name, df in (("plain", plain), ("hot", way)):
    spark.sparkContext.setJobDescription(name)
    df.write.format("noop").mode("overwrite").save()
spark.stop()
"""


def largest_over_median(log, name):
    """Of the stages of the named jobs: records read by the largest task over those of the median."""
    stages, tasks = set(), {}
    for path in glob.glob(f"{log}/**/*", recursive=True):
        if os.path.isfile(path) and not path.endswith(".crc"):
            for line in open(path):
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart" and e["Properties"].get("spark.job.description") == name:
                    stages |= set(e["Stage IDs"])
                if e["Event"] == "SparkListenerTaskEnd":
                    m = e["Task Metrics"]["Shuffle Read Metrics"]
                    tasks.setdefault(e["Stage ID"], []).append(m["Total Records Read"])
    found = max((sorted(t) for s, t in tasks.items() if s in stages), key=sum)
    assert sum(found) > 300_000
    return found[-1] / found[len(found) // 2]


def test_no_task_reads_a_hot_key(tmp_path):
    """Stage figures of the event log, with a third of the rows on one key."""
    log = str(tmp_path / "log")
    os.mkdir(log)
    subprocess.run([sys.executable, "-c", _SKEW.format(root=ROOT, log=log)], check=True, timeout=300, capture_output=True)
    assert largest_over_median(log, "plain") > 3
    assert largest_over_median(log, "hot") < 2


# ---------------------------------------------------------------- quantiles
SHARES = (0.0, 0.01, 0.05, 0.25, 0.5, 0.77, 0.95, 1.0)


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


@pytest.mark.parametrize("kind", ["ties", "wide", "tiny", "integers", "special", "one", "none", "two"])
def test_quantiles_equal_percentile(spark, kind):
    rng = random.Random(kind)
    values = {
        "ties": [rng.choice([1.5, 2.5, 2.5, 7.0]) for _ in range(500)] + [None] * 20,
        "wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 308) for _ in range(3000)] + [1.7e308, -1.7e308],
        "tiny": [rng.randrange(200) * 5e-324 for _ in range(300)] + [1e300, 1e-300],
        "integers": [float(rng.randrange(10 ** 6)) for _ in range(5000)],
        "special": [float("inf"), float("-inf"), 0.0, -0.0, 1.0, float("inf"), None] * 5,
        "one": [3.25], "none": [None, None], "two": [1.0, 2.0],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    want = df.agg(F.percentile("x", F.array(*map(F.lit, SHARES)))).first()[0] or [None] * len(SHARES)
    got = exact_quantiles(df, "x", SHARES)
    assert all(same(a, b) for a, b in zip(got, want)), (got, want)


def test_quantiles_keep_no_value_map(spark):
    """Many distinct values: at most BINS rows a span come to the driver, and two shuffled columns."""
    df = spark.range(200_000).select((F.xxhash64("id") / 1e9).alias("x"))
    want = df.agg(F.percentile("x", F.array(*map(F.lit, SHARES)))).first()[0]
    assert exact_quantiles(df, "x", SHARES) == want


# ---------------------------------------------------------------- text with line breaks in quotes
def awkward_rows(rng, n):
    pieces = ['plain', 'with, comma', 'say "hi"', 'two\nlines', 'a\n\n"b",\nc', '', ' é, ç ', '"', '\n', 'x' * 300, 'a\r\nb']
    return [[str(i)] + [rng.choice(pieces) for _ in range(3)] for i in range(n)]


def write_csv(path, header, data, sep=",", end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, delimiter=sep, lineterminator=end)
        w.writerow(header)
        w.writerows(data)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("split", ["512", "2048", "1000000"])
def test_one_file_read_by_many_tasks(spark, tmp_path, split, end):
    data = awkward_rows(random.Random(split), 400)
    data[7][2] = "long\n" * 2000  # over many ranges
    path = str(tmp_path / "a.csv")
    write_csv(path, ["id", "a b", "c", "d"], data, end=end)
    keys = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = read_csv(spark, path, multi_line=True)
        assert df.columns == ["id", "a b", "c", "d"]
        if split == "512":
            assert spark.read.text(path).rdd.getNumPartitions() > 50
        got = {int(r[0]): [x if x is not None else "" for x in r[1:]] for r in df.collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(got) == len(data)
    for r in data:
        assert [x.replace("\r\n", "\n") for x in got[int(r[0])]] == [x.replace("\r\n", "\n") for x in r[1:]]


def test_extracts_of_different_headers_with_line_breaks(spark, tmp_path):
    rng = random.Random(2)
    write_csv(str(tmp_path / "a.csv"), ["id", "x", "y", "z"], awkward_rows(rng, 30), ";")
    write_csv(str(tmp_path / "b.csv"), ["y", "id", "w", "v"], [[r[1], r[0], r[2], r[3]] for r in awkward_rows(rng, 20)], ";")
    df = read_flights_csv(spark, str(tmp_path / "*.csv"), multi_line=True)
    assert set(df.columns) == {"id", "x", "y", "z", "w", "v"} and df.count() == 50


def test_ragged_row_fails(spark, tmp_path):
    path = str(tmp_path / "bad.csv")
    open(path, "w").write('a,b\n1,"x\ny"\n2\n')
    with pytest.raises(Exception):
        read_csv(spark, path, multi_line=True).collect()


def test_ndjson_of_any_csv(spark, tmp_path):
    data = awkward_rows(random.Random(4), 60)
    write_csv(str(tmp_path / "a.csv"), ["id", "x", "y", "z"], data)
    csv_to_ndjson(spark, str(tmp_path / "a.csv"), str(tmp_path / "json"))
    got = [json.loads(line) for p in glob.glob(f"{tmp_path}/json/part-*") for line in open(p, encoding="utf-8")]
    assert sorted((r["id"], r.get("x", "").replace("\r\n", "\n")) for r in got) == \
        sorted((r[0], r[1].replace("\r\n", "\n")) for r in data)


def test_only_torn_ranges_are_read_again(spark, tmp_path):
    """No job runs to plan the read, and ranges that no record crosses are assembled once."""
    from aerolake.sources import quoted
    plain, broken = str(tmp_path / "plain.csv"), str(tmp_path / "broken.csv")
    write_csv(plain, ["id", "x"], [[i, 'a "b", c'] for i in range(300)])
    write_csv(broken, ["id", "x"], [[i, "text\n" * 300 if i == 150 else "a"] for i in range(300)])
    keys = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("quoted-plan", "planning only")
        records = [quoted.quoted_records(spark, [p]) for p in (plain, broken)]
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("quoted-plan")) == []
        assert [r.count() for r in records] == [300, 300]
        starts = [quoted._starts(quoted._lines(spark, [p])) for p in (plain, broken)]
        assert starts[0].where("torn").count() == 0 and starts[0].count() > 5
        assert 2 <= starts[1].where("torn").count() < starts[1].count()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in old.items():
            spark.conf.set(k, v)


def test_ndjson_compressed_in_files_of_bounded_rows(spark, tmp_path):
    write_csv(str(tmp_path / "a.csv"), ["id", "x", "y", "z"], awkward_rows(random.Random(5), 400))
    csv_to_ndjson(spark, str(tmp_path / "a.csv"), str(tmp_path / "plain"))
    csv_to_ndjson(spark, str(tmp_path / "a.csv"), str(tmp_path / "small"), compression="gzip", rows_per_file=100)
    files = {k: glob.glob(f"{tmp_path}/{k}/part-*") for k in ("plain", "small")}
    size = {k: sum(os.path.getsize(f) for f in v) for k, v in files.items()}
    assert len(files["small"]) >= 4 and size["small"] < 0.7 * size["plain"]
    schema = "id string, x string, y string, z string"
    got = {k: sorted(map(str, spark.read.schema(schema).json(f"{tmp_path}/{k}").collect())) for k in files}
    assert got["small"] == got["plain"] and len(got["plain"]) == 400


# ---------------------------------------------------------------- first rows in source order
def test_head_reads_only_the_first_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 10_000, 1, 20).select("id", (F.col("id") % 5).alias("g")).write.parquet(path)
    df = spark.read.parquet(path)
    assert [r.id for r in head_in_source_order(df, 7).collect()] == list(range(7))
    head = head_in_source_order(df, 250, F.col("g") == 2)
    assert [r.id for r in head.collect()] == [i for i in range(10_000) if i % 5 == 2][:250]
    assert head.columns == ["id", "g"]
    scans = [n for n in _scans(head)]
    assert scans and max(m["numFiles"] for m in scans) <= 7  # 1 + 2 + 4 of 20
    assert [r.id for r in head_in_source_order(df, 10 ** 6, F.col("g") == 9).collect()] == []
    assert head_in_source_order(df, 10 ** 6).count() == 10_000


def _scans(df):
    """Metrics of the scans of the executed plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, out = [plan], []
    while todo:
        p = todo.pop()
        kind = p.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(p.executedPlan())
        if kind.endswith("QueryStageExec"):
            todo.append(p.plan())
        if kind == "FileSourceScanExec":
            m = p.metrics()
            out.append({k: m.apply(k).value() for k in ("numFiles", "numOutputRows")})
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return out


# ---------------------------------------------------------------- clustering
def test_clustered_table_skips_row_groups(spark, tmp_path):
    flights = testbed.clean_flights(spark, SF001)
    flights = flights.crossJoin(spark.range(12).select(F.col("id").alias("copy"))).drop("copy")
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_clean(flights, str(tmp_path / "plain"), partition_by_year=False)
        write_clean(flights, str(tmp_path / "sorted"), partition_by_year=False, cluster_by=(COLS.origin_icao, COLS.airline_icao))
    finally:
        spark.conf.set(key, old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spec = FilterSpec(origin_icao=("3",))
    read, found = {}, {}
    for name in ("plain", "sorted"):
        df = apply_filters(spark.read.parquet(str(tmp_path / name)), spec)
        found[name] = rows(df)
        read[name] = sum(m["numOutputRows"] for m in _scans(df))
    assert found["plain"] == found["sorted"] and found["plain"]
    assert read["sorted"] < read["plain"] / 3


# ---------------------------------------------------------------- Parquet files that drift
def drifting(spark, folder):
    frames = [
        spark.range(5).select(F.col("id").cast("int").alias("a"), F.lit("x").alias("b")),
        spark.range(5, 9).select(F.col("id").cast("int").alias("a"), F.lit(1.5).alias("c")),
        spark.range(9, 12).select((F.col("id") + 0.5).alias("a"), F.lit("y").alias("b")),
        spark.range(12, 14).select(F.col("id").alias("a"), F.lit(3).alias("b")),
        spark.range(14, 15).select(F.col("id").cast("int").alias("a"), F.lit(True).alias("d"))]
    for k, df in enumerate(frames):
        df.coalesce(1).write.parquet(f"{folder}/p{k}")


def test_drifting_types_are_read_without_loss(spark, tmp_path):
    from aerolake.sources import read_parquet_relaxed
    drifting(spark, str(tmp_path))
    df = read_parquet_relaxed(spark, str(tmp_path))
    assert dict(df.dtypes) == {"a": "double", "b": "string", "c": "double", "d": "boolean"}
    got = {r.a: (r.b, r.c, r.d) for r in df.collect()}
    assert len(got) == 15 and got[3.0] == ("x", None, None) and got[6.0] == (None, 1.5, None) and got[9.5] == ("y", None, None)
    assert got[13.0] == ("3", None, None) and got[14.0] == (None, None, True)
    with pytest.raises(FileNotFoundError):
        read_parquet_relaxed(spark, str(tmp_path / "none"))


def test_agreeing_files_are_read_together_in_few_jobs(spark, tmp_path, monkeypatch):
    import aerolake.sources.drift as drift
    for k in range(16):
        kind = "int" if k < 11 else "double"
        spark.range(1).select(F.lit(k).cast(kind).alias("a"), F.lit(k).alias(f"only{k % 3}")).coalesce(1).write.parquet(f"{tmp_path}/p{k:02d}")
    looks = []
    real = drift._merged
    monkeypatch.setattr(drift, "_merged", lambda s, p: looks.append(len(p)) or real(s, p))
    files = [f for f, _, _ in drift.list_files(spark, str(tmp_path))]
    groups = drift.schema_groups(spark, files)
    assert sorted(len(p) for _, p in groups) == [5, 11] and len(looks) <= 9
    assert all({"only0", "only1", "only2"} <= set(s.names) for s, _ in groups)
