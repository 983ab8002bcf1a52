import datetime as dt

import pytest

from pyspark.sql import functions as F

from aerolake.columns import COLS
from aerolake.operators import (FilterSpec, apply_filters, date_bounds, delay_base,
                                delay_by_weekday, flights_per_day, kpis, route_intensity,
                                route_map, route_nodes, status_distribution, top_airlines_per_year,
                                top_routes, unique_values, yoy_decreases, yoy_increases,
                                yoy_variation, yoy_variation_with_fallback)
from conftest import rows

SCHEMA = (f"`{COLS.airline}` string, `{COLS.origin_icao}` string, `{COLS.dest_icao}` string, "
          f"`{COLS.origin_name}` string, `{COLS.dep_planned}` timestamp_ntz, "
          f"`{COLS.dep_real}` timestamp_ntz, `{COLS.status}` string, "
          f"`{COLS.origin_coords}` string, `{COLS.dest_coords}` string")

T = dt.datetime


def flight(airline="Gol", o="SBGR", d="SBSP", name="Guarulhos", pp=T(2021, 5, 3, 10, 0),
           delay_s=0, status="Ok", oc="-46.47, -23.43", dc="-23.62,-46.65"):
    pr = pp + dt.timedelta(seconds=delay_s) if pp else None
    return (airline, o, d, name, pp, pr, status, oc, dc)


def test_kpis_null_counts_as_value(spark):
    df = spark.createDataFrame([flight(), flight(airline=None), flight(o=None), flight(airline="Azul")],
                               SCHEMA)
    assert rows(kpis(df)) == [(4, 3, 2)]
    empty = df.limit(0)
    assert rows(kpis(empty)) == [(0, 0, 0)]


def test_filters(spark):
    df = spark.createDataFrame([flight(airline="Gol", pp=T(2021, 5, 31, 23, 59)),
                                flight(airline="Azul", pp=T(2021, 6, 1, 0, 0)),
                                flight(airline=None, pp=T(2021, 5, 1, 8, 0))], SCHEMA)
    assert apply_filters(df, FilterSpec()).count() == 3
    assert apply_filters(df, FilterSpec(airlines=("Gol",))).count() == 1
    assert apply_filters(df, FilterSpec(airlines=("Nope",))).count() == 0
    assert apply_filters(df, FilterSpec(day_end="2021-05-31")).count() == 2     # end day whole
    assert apply_filters(df, FilterSpec(day_start="2021-05-31")).count() == 2   # open end
    text = df.withColumn(COLS.dep_planned, df[f"`{COLS.dep_planned}`"].cast("string"))
    assert apply_filters(text, FilterSpec(day_end="2021-05-31")).count() == 2


def test_overview_aggregates(spark):
    df = spark.createDataFrame([flight(status="Ok"), flight(status="Atrasado"), flight(status="Atrasado"),
                                flight(o="SBSP", d="SBGR", pp=T(2021, 5, 4, 1, 0))], SCHEMA)
    assert rows(status_distribution(df)) == [("Atrasado", 2), ("Ok", 2)]     # tie → by status
    per_day = rows(flights_per_day(df))
    assert per_day == [(dt.date(2021, 5, 3), 3), (dt.date(2021, 5, 4), 1)]
    assert sum(n for _, n in per_day) == df.count()
    assert rows(top_routes(df, 1), "origem", "destino", "quantidade", "rota") == \
        [("SBGR", "SBSP", 3, "SBGR ➔ SBSP")]
    assert rows(unique_values(df, COLS.origin_icao)) == [("SBGR",), ("SBSP",)]
    assert rows(date_bounds(df, COLS.dep_planned)) == [(T(2021, 5, 3, 10, 0), T(2021, 5, 4, 1, 0))]
    assert rows(date_bounds(df, COLS.status)) == [(None, None)]


def test_delay_threshold_is_strict(spark):
    df = spark.createDataFrame([flight(delay_s=15 * 60), flight(delay_s=15 * 60 + 59),
                                flight(delay_s=16 * 60), flight(pp=None)], SCHEMA)
    base = delay_base(df, 15)
    assert rows(base, "atraso_min") == [(16,)]


def test_weekday_labels_in_breakdown(spark):
    df = spark.createDataFrame([flight(pp=T(2024, 1, 1, 10), delay_s=3600),
                                flight(pp=T(2024, 1, 7, 10), delay_s=3600)], SCHEMA)
    got = sorted(rows(delay_by_weekday(delay_base(df, 15)), "dia_sem", "dia"))
    assert got == [(1, "Seg"), (7, "Dom")]


def _late(name, year, n):
    return [flight(name=name, pp=T(year, 3, 10, 10), delay_s=3600) for _ in range(n)]


def test_yoy_delta_and_top(spark):
    data = _late("A", 2020, 3) + _late("B", 2021, 2) + _late("A", 2021, 1) + _late("C", 2019, 5)
    base = delay_base(spark.createDataFrame(data, SCHEMA), 15)
    var = {r.aeroporto: (r.y_prev, r.y_curr, r.delta, r.ano_prev, r.ano_curr)
           for r in yoy_variation(base).collect()}
    assert var == {"A": (3, 1, -2, 2020, 2021), "B": (0, 2, 2, 2020, 2021)}
    assert rows(yoy_increases(yoy_variation(base), 1), "aeroporto") == [("B",)]
    assert rows(yoy_decreases(yoy_variation(base), 1), "aeroporto") == [("A",)]


def test_yoy_one_year_then_fallback(spark):
    data = _late("A", 2020, 3) + _late("A", 2021, 1)
    base = delay_base(spark.createDataFrame(data, SCHEMA), 15)
    one = base.filter("ano = 2021")
    assert yoy_variation(one).count() == 0
    for in_range, used in ((F.col("ano") == 2021, True), (F.col("ano") >= 2020, False), (F.lit(False), True), (None, False)):
        assert rows(yoy_variation_with_fallback(base, in_range), "aeroporto", "delta", "usou_fallback") == [("A", -2, used)]
    # The range decides by its own years, also when other years are later.
    data += _late("A", 2022, 9)
    base = delay_base(spark.createDataFrame(data, SCHEMA), 15)
    got = rows(yoy_variation_with_fallback(base, F.col("ano") < 2022), "aeroporto", "delta", "ano_curr", "usou_fallback")
    assert got == [("A", -2, 2021, False)]


def test_yoy_reads_the_base_once(spark, tmpdir_str):
    base = delay_base(spark.createDataFrame(_late("A", 2020, 3) + _late("A", 2021, 1), SCHEMA), 15)
    base.write.parquet(f"{tmpdir_str}/base")
    stored = spark.read.parquet(f"{tmpdir_str}/base")
    for df in (yoy_variation(stored), yoy_variation_with_fallback(stored, F.col("ano") == 2021)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1


def test_dense_rank_ties_kept(spark):
    data = []
    for i in range(16):                       # 16 airlines, two tied at the 15th count
        n = 20 - i if i < 15 else 6
        data += [flight(airline=f"L{i:02d}", pp=T(2021, 1, 1, 10), delay_s=3600)] * n
    base = delay_base(spark.createDataFrame(data, SCHEMA), 15)
    out = top_airlines_per_year(base, 15)
    assert out.count() == 16


def test_routes_nodes_intensity(spark):
    data = ([flight(delay_s=1800)] * 3 + [flight(o="SBSP", d="SBGR", oc="-23.62,-46.65",
                                                  dc="-46.47, -23.43", delay_s=3600)]
            + [flight(oc="-9.13, 38.77", delay_s=600)] + [flight(oc=None)])
    base = delay_base(spark.createDataFrame(data, SCHEMA), 0)
    routes = route_map(base, "auto", 10, True)
    got = rows(routes, "origem_lon", "origem_lat", "destino_lon", "destino_lat", "quantidade", "atraso_medio")
    assert got == [(-46.47, -23.43, -46.65, -23.62, 3, 30.0), (-46.65, -23.62, -46.47, -23.43, 1, 60.0)]
    nodes = route_nodes(routes)
    assert sum(r.quantidade for r in nodes.collect()) == 2 * sum(r[4] for r in got)
    inten = [r.intensidade for r in route_intensity(routes).collect()]
    assert all(0.0 <= x <= 1.0 for x in inten)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_partitioning_invariance(spark, parts):
    data = _late("A", 2020, 3) + _late("B", 2021, 2) + [flight(airline=None)]
    df = spark.createDataFrame(data, SCHEMA).repartition(parts)
    assert rows(kpis(df)) == [(6, 2, 1)]
    assert sorted(rows(yoy_variation(delay_base(df, 15)), "aeroporto", "delta")) == [("A", -3), ("B", 2)]


def test_guards_on_column_poor_input(spark):
    from aerolake.operators import (delay_by_airline, delay_by_airport, delay_by_period,
                                    delay_by_year, status_distribution, unique_values)
    df = spark.createDataFrame([(1,)], "x int")
    base = delay_base(df)
    assert base.count() == 0 and {"atraso_min", "ano", "dia_sem", "hora"} <= set(base.columns)
    checks = {
        "per_day": (flights_per_day(df), ["dia", "voos"]),
        "status": (status_distribution(df), ["status", "quantidade"]),
        "routes": (top_routes(df), ["origem", "destino", "quantidade", "rota"]),
        "unique": (unique_values(df, "nope"), ["valor"]),
        "airport": (delay_by_airport(base), ["aeroporto", "quantidade_atrasos"]),
        "year": (delay_by_year(base), ["ano", "quantidade_atrasos"]),
        "weekday": (delay_by_weekday(base), ["ano", "dia_sem", "quantidade_atrasos", "dia"]),
        "period": (delay_by_period(base), ["ano", "periodo", "quantidade_atrasos"]),
        "airline": (delay_by_airline(base), ["ano", "empresa", "quantidade_atrasos"]),
        "top": (top_airlines_per_year(base), ["ano", "empresa", "quantidade_atrasos"]),
        "yoy": (yoy_variation(base), ["aeroporto", "y_prev", "y_curr", "ano_prev", "ano_curr", "delta"]),
        "map": (route_map(base), ["origem_lon", "origem_lat", "destino_lon", "destino_lat",
                                  "quantidade", "atraso_medio"]),
    }
    for name, (out, cols) in checks.items():
        assert out.columns == cols, name
        assert out.count() == 0, name
    assert rows(kpis(df)) == [(1, 0, 0)]
    assert rows(date_bounds(df, "x")) == [(None, None)]
    assert yoy_variation_with_fallback(base, None).count() == 0
