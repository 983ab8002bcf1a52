import io
import os
from contextlib import redirect_stdout

from aerolake.columns import AIRLINE_FIELDS, AIRPORT_FIELDS, CLEAN_COLUMNS, COLS, RAW_COLUMNS, string_schema
from aerolake.operators import FilterSpec
from aerolake.plans import report, unpersist_report
from aerolake.plans import testbed
from aerolake.streaming import stream_clean
from conftest import SF001

import __spark_entry__ as entry


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_clean_plan_is_broadcast_and_udf_free(spark):
    clean = testbed.clean_flights(spark, SF001)
    p = plan(entry.queries()["delay_by_year"](spark, SF001))
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    lazy = plan(testbed.raw_flights(spark, SF001))
    assert "BroadcastHashJoin" in lazy
    assert clean.count() > 0


def test_topk_and_rank_limit_plans(spark):
    assert "TakeOrderedAndProject" in plan(entry.queries()["top_routes"](spark, SF001))
    assert "WindowGroupLimit" in plan(entry.queries()["top_airlines_per_year"](spark, SF001))


def test_filters_reach_the_scan_and_prune_years(spark, tmp_path):
    from aerolake.operators import apply_filters
    from aerolake.sources import YEAR_PARTITION, write_clean
    p = plan(entry.queries()["filter_flights"](spark, SF001))
    assert "PushedFilters" in p and "IsNotNull" in p
    write_clean(testbed.clean_flights(spark, SF001), str(tmp_path / "clean"))
    stored = spark.read.parquet(str(tmp_path / "clean"))
    p = plan(apply_filters(stored, entry.FILTER_SPEC, year_col=YEAR_PARTITION))
    assert "PartitionFilters: [isnotnull(ano_partida" in p


def test_one_scan_of_the_flights(spark):
    for name in ("filter_options", "kpis", "yoy_variation", "yoy_fallback", "delay_by_year", "delay_base"):
        df = entry.queries()[name](spark, SF001)
        p = df._jdf.queryExecution().executedPlan().toString()
        assert p.count("l_returnflag") and p.count("lineitem.parquet") == 1, name
    assert "Expand" not in plan(entry.queries()["filter_options"](spark, SF001))


def test_answers_follow_the_tables(spark, tmp_path):
    """Changed input in the same session changes the answer."""
    import shutil
    folder = tmp_path / "sf"
    shutil.copytree(SF001, folder)
    before = entry.queries()["kpis"](spark, str(folder)).first().voos
    half = spark.read.parquet(f"{SF001}/lineitem.parquet").where("l_orderkey % 2 = 0").toPandas()
    (folder / "lineitem.parquet").chmod(0o644)
    half.to_parquet(folder / "lineitem.parquet", coerce_timestamps="us")
    spark.catalog.clearCache()
    assert 0 < entry.queries()["kpis"](spark, str(folder)).first().voos < before


def test_session_zone_is_put_back(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = entry.queries()["delay_by_year"](spark, SF001)
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
        there = sorted(map(tuple, df.collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert there == sorted(map(tuple, entry.queries()["delay_by_year"](spark, SF001).collect()))


def test_report_bundle(spark):
    clean = testbed.clean_flights(spark, SF001)
    out = report(clean, FilterSpec(day_start="1996-01-01", day_end="1997-12-31"))
    try:
        assert out["missing_columns"] == []
        k = out["kpis"].collect()[0]
        assert k.voos == out["filtered"].count()
        assert sum(r.quantidade for r in out["status"].collect()) == k.voos
        assert sum(r.voos for r in out["per_day"].collect()) == k.voos
        assert out["sample"].count() == min(1000, k.voos)
        for key in ("aeroportos", "variacao", "por_ano", "dias_semana", "periodos", "companhias",
                    "rotas", "nos", "intensidade"):
            out[key].collect()
    finally:
        unpersist_report(out)


def test_streaming_clean_matches_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    raw = testbed.raw_flights(spark, SF001).limit(400).toPandas()
    half = len(raw) // 2
    raw.iloc[:half].to_csv(src / "part1.csv", sep=";", index=False)
    raw.iloc[half:].to_csv(src / "part2.csv", sep=";", index=False)
    airports, airlines = testbed.airports(spark, SF001), testbed.airlines(spark, SF001)
    q = stream_clean(spark, str(src), RAW_COLUMNS, airports, airlines, str(tmp_path / "out"),
                     str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    streamed = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(streamed.columns) == sorted(CLEAN_COLUMNS)
    from aerolake.plans.transform import transform
    batch = transform(spark.createDataFrame(raw.astype(object).where(raw.notna(), None),
                                            string_schema(RAW_COLUMNS)), airports, airlines)
    assert streamed.count() == batch.count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["origem", "destino", "quantidade", "rota"]
    assert 0 < df.count() <= 20


def test_every_query_has_an_oracle():
    assert set(entry._QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_no_python_evaluation_in_any_query(spark):
    for name in entry._QUERIES:
        p = plan(entry.queries()[name](spark, SF001))
        for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                     "MapInPandas", "CartesianProduct"):
            assert node not in p, (name, node)


def test_invariants(spark):
    from pyspark.sql import functions as F
    q = entry.queries()
    raw_n = testbed.raw_flights(spark, SF001).count()
    clean_n = q["clean_flights"](spark, SF001).count()
    assert 0 < clean_n <= raw_n
    assert sum(r.quantidade for r in q["status_distribution"](spark, SF001).collect()) == clean_n
    assert sum(r.voos for r in q["flights_per_day"](spark, SF001).collect()) == clean_n
    assert q["kpis"](spark, SF001).collect()[0].voos == clean_n
    routes = q["route_map"](spark, SF001).agg(F.sum("quantidade")).collect()[0][0]
    nodes = q["route_nodes"](spark, SF001).agg(F.sum("quantidade")).collect()[0][0]
    assert nodes == 2 * routes
    var = q["yoy_variation"](spark, SF001)
    assert var.where("delta <> y_curr - y_prev").count() == 0
    late = q["late_flag"](spark, SF001)
    wrong = late.where(
        "(status_voo = 'Atrasado') <> coalesce(partida_real > partida_prevista "
        "OR chegada_real > chegada_prevista, false)")
    assert wrong.count() == 0
    base = q["delay_base"](spark, SF001)
    assert base.where("atraso_min <= 15").count() == 0
    assert q["delay_by_year"](spark, SF001).agg(F.sum("quantidade_atrasos")).collect()[0][0] == base.count()


def test_streaming_rejects_drifted_header(spark, tmp_path):
    import pytest
    from aerolake.streaming import read_flights_stream
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("b;a\n1;2\n", encoding="utf-8")     # columns swapped
    stream = read_flights_stream(spark, str(src), ["a", "b"])
    q = (stream.writeStream.format("memory").queryName("drift_check")
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    with pytest.raises(Exception):
        q.awaitTermination(120)
        if q.exception() is not None:
            raise q.exception()
    q.stop()
