import json
import os

import pytest
from pyspark.sql import types as T

from aerolake.columns import AIRPORT_FIELDS
from aerolake.plans.transform import load_or_build
from aerolake.sources import (common_type, csv_to_ndjson, export_csv, export_parquet,
                              read_code_map, read_flights_csv, read_lookup_records,
                              union_relaxed, write_clean)
from conftest import rows


def _write(path, text):
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_csv_header_drift_union_by_name(spark, tmpdir_str):
    _write(os.path.join(tmpdir_str, "a.csv"),
           "Número Voo;ICAO Empresa Aérea;Situação Voo\n0042;GLO;REALIZADO\n7;AZU;CANCELADO\n")
    # other column order, a column missing, a numeric-looking column
    _write(os.path.join(tmpdir_str, "b.csv"),
           "ICAO Empresa Aérea;Número Voo\nTAM;123\n")
    df = read_flights_csv(spark, os.path.join(tmpdir_str, "*.csv"))
    assert all(isinstance(f.dataType, T.StringType) for f in df.schema.fields)
    got = sorted(rows(df, "Número Voo", "ICAO Empresa Aérea", "Situação Voo"))
    assert got == [("0042", "GLO", "REALIZADO"), ("123", "TAM", None), ("7", "AZU", "CANCELADO")]


def test_csv_no_match_is_an_error(spark, tmpdir_str):
    with pytest.raises(FileNotFoundError):
        read_flights_csv(spark, os.path.join(tmpdir_str, "*.csv"))


def test_common_type_rules():
    assert common_type([T.IntegerType(), T.LongType()]) == T.LongType()
    assert common_type([T.IntegerType(), T.DoubleType()]) == T.DoubleType()
    assert common_type([T.IntegerType(), T.StringType()]) == T.StringType()


def test_union_relaxed_types_and_missing(spark):
    a = spark.createDataFrame([(1, "x")], "id int, code string")
    b = spark.createDataFrame([(2, 5)], "id long, code int")
    c = spark.createDataFrame([(3,)], "id int")
    out = union_relaxed([a, b, c])
    assert dict(out.dtypes) == {"id": "bigint", "code": "string"}
    assert sorted(rows(out)) == [(1, "x"), (2, "5"), (3, None)]


def test_lookup_records_array_and_ndjson(spark, tmpdir_str):
    recs = [{"icao_code": "SBGR", "name": "Guarulhos", "type": "large_airport", "extra": 1},
            {"icao_code": "SBSP", "name": "Congonhas", "type": "medium_airport"}]
    arr = os.path.join(tmpdir_str, "airports.json")
    _write(arr, json.dumps(recs, indent=2))
    nd = os.path.join(tmpdir_str, "airports.ndjson")
    _write(nd, "\n".join(json.dumps(r) for r in recs))
    for path, fmt in ((arr, "array"), (nd, "ndjson")):
        df = read_lookup_records(spark, path, AIRPORT_FIELDS, fmt)
        assert sorted(rows(df, "icao_code", "type")) == [("SBGR", "large_airport"),
                                                         ("SBSP", "medium_airport")]


def test_read_code_map(spark, tmpdir_str):
    p = os.path.join(tmpdir_str, "codes.json")
    _write(p, '{\n  "C": "Regular",\n\n  "N": "Charter"\n}')
    assert sorted(rows(read_code_map(spark, p))) == [("C", "Regular"), ("N", "Charter")]


def test_csv_to_ndjson_roundtrip(spark, tmpdir_str):
    src = os.path.join(tmpdir_str, "in.csv")
    _write(src, "icao_code,name\nSBGR,Guarulhos\n")
    dst = os.path.join(tmpdir_str, "out")
    csv_to_ndjson(spark, src, dst)
    df = read_lookup_records(spark, dst, ["icao_code", "name"], "ndjson")
    assert rows(df) == [("SBGR", "Guarulhos")]


def test_writers_and_load_or_build(spark, tmpdir_str):
    import datetime as dt
    df = spark.createDataFrame([("A", dt.datetime(2021, 1, 2, 3, 4)), ("B", dt.datetime(2022, 5, 6, 7, 8))],
                               "`Número Voo` string, `Partida Prevista` timestamp_ntz")
    clean = os.path.join(tmpdir_str, "clean")
    with pytest.raises(FileNotFoundError):
        load_or_build(spark, clean)

    def build():
        write_clean(df, clean)
        return spark.read.parquet(clean)

    out = load_or_build(spark, clean, build)
    assert sorted(n for n in os.listdir(clean) if not n.startswith(".")) == \
        ["_SUCCESS", "ano_partida=2021", "ano_partida=2022"]
    assert out.count() == 2
    assert load_or_build(spark, clean, lambda: 1 / 0).count() == 2     # reused, not rebuilt
    export_parquet(df, os.path.join(tmpdir_str, "p"))
    export_csv(df, os.path.join(tmpdir_str, "c"))
    assert spark.read.parquet(os.path.join(tmpdir_str, "p")).count() == 2
    assert spark.read.option("header", True).csv(os.path.join(tmpdir_str, "c")).columns == \
        ["Número Voo", "Partida Prevista"]


def test_run_batch_csv_to_clean_parquet(spark, tmpdir_str):
    from aerolake.columns import CLEAN_COLUMNS
    from aerolake.plans import run_batch
    from aerolake.sources import YEAR_PARTITION
    head = ("ICAO Empresa Aérea;Número Voo;Código Autorização (DI);Código Tipo Linha;"
            "ICAO Aeródromo Origem;ICAO Aeródromo Destino;Partida Prevista;Partida Real;"
            "Chegada Prevista;Chegada Real;Situação Voo;Código Justificativa")
    row = "GLO;0042;X;C;SBGR;SBSP;2021-05-03 10:00:00;2021-05-03 10:30:00;2021-05-03 12:00:00;2021-05-03 12:10:00;REALIZADO;AA"
    _write(os.path.join(tmpdir_str, "jan.csv"), head + "\n" + row + "\n")
    # second extract: columns reordered, one row cancelled
    head2 = ";".join(reversed(head.split(";")))
    row2 = ";".join(reversed(row.replace("REALIZADO", "CANCELADO").split(";")))
    _write(os.path.join(tmpdir_str, "feb.csv"), head2 + "\n" + row2 + "\n")
    airports = [{"icao_code": c, "name": n, "continent": "SA", "iso_country": "BR",
                 "municipality": "SP", "gps_code": c, "coordinates": xy, "type": "large_airport"}
                for c, n, xy in (("SBGR", "Guarulhos", "-46.47,-23.43"), ("SBSP", "Congonhas", "-46.65,-23.62"))]
    _write(os.path.join(tmpdir_str, "airports.json"), json.dumps(airports))
    _write(os.path.join(tmpdir_str, "airlines.json"), json.dumps([{"Nome": "Gol", "Sigla": "GLO"}]))
    out = run_batch(spark, out_path=os.path.join(tmpdir_str, "clean"),
                    airports_path=os.path.join(tmpdir_str, "airports.json"),
                    airlines_path=os.path.join(tmpdir_str, "airlines.json"),
                    csv_glob=os.path.join(tmpdir_str, "*.csv"))
    assert sorted(out.columns) == sorted(list(CLEAN_COLUMNS) + [YEAR_PARTITION])
    r = out.collect()
    assert len(r) == 1 and r[0]["Número Voo"] == "0042" and r[0]["Status do Voo"] == "Atrasado"
    assert r[0]["Empresa Aérea"] == "Gol" and r[0][YEAR_PARTITION] == 2021


def test_paths_and_headers(spark, tmpdir_str):
    from aerolake.sources.files import expand_glob, first_lines, is_committed, path_exists
    os.makedirs(os.path.join(tmpdir_str, "2021"))
    os.makedirs(os.path.join(tmpdir_str, "2022"))
    long = ";".join(f"c{i}" for i in range(300_000))      # a header of over a megabyte
    _write(os.path.join(tmpdir_str, "2021", "x.csv"), long + "\n1\n")
    _write(os.path.join(tmpdir_str, "2022", "y.csv"), "\ufeffa;b\n1;2\n")
    uri = "file://" + tmpdir_str
    found = expand_glob(spark, uri + "/20*/*.csv")
    assert [p.rsplit("/", 2)[1:] for p in found] == [["2021", "x.csv"], ["2022", "y.csv"]]
    assert expand_glob(spark, os.path.join(tmpdir_str, "none*")) == []
    assert first_lines(spark, found) == [long, "a;b"]
    spark.range(3).write.parquet(os.path.join(tmpdir_str, "t"))
    assert is_committed(spark, uri + "/t") and is_committed(spark, os.path.join(tmpdir_str, "t"))
    os.makedirs(os.path.join(tmpdir_str, "half"))
    assert path_exists(spark, uri + "/half") and not is_committed(spark, uri + "/half")
    assert not is_committed(spark, uri + "/missing")


def test_half_written_table_is_built_again(spark, tmpdir_str):
    from aerolake.plans import load_or_build
    half = os.path.join(tmpdir_str, "half")
    os.makedirs(half)
    assert load_or_build(spark, half, lambda: "built") == "built"
    with pytest.raises(FileNotFoundError):
        load_or_build(spark, half)
    spark.range(2).write.mode("overwrite").parquet(half)
    assert load_or_build(spark, half, lambda: "built").count() == 2


def test_csv_dialect(spark, tmpdir_str):
    from aerolake.sources import export_csv, read_csv, read_flights_csv
    path = os.path.join(tmpdir_str, "latin.csv")
    with open(path, "wb") as fh:
        fh.write("Número Voo;Situação Voo\n0042;\"x \"\"y\"\" z; é\"\n".encode("iso-8859-1"))
    df = read_flights_csv(spark, path, encoding="ISO-8859-1")
    assert df.columns == ["Número Voo", "Situação Voo"] and rows(df) == [("0042", 'x "y" z; é')]
    with pytest.raises(Exception):                        # undecodable header
        read_flights_csv(spark, path)
    for ragged in ("a;b\n1;2\n3;4;5\n", "a;b\n1\n"):
        _write(os.path.join(tmpdir_str, "ragged.csv"), ragged)
        with pytest.raises(Exception):
            read_flights_csv(spark, os.path.join(tmpdir_str, "ragged.csv")).collect()
    assert rows(read_flights_csv(spark, os.path.join(tmpdir_str, "ragged.csv"), mode="PERMISSIVE")) == [("1", None)]
    _write(os.path.join(tmpdir_str, "lines.csv"), 'a,b\n"one\ntwo",3\n')
    assert rows(read_csv(spark, os.path.join(tmpdir_str, "lines.csv"), multi_line=True)) == [("one\ntwo", "3")]
    export_csv(spark.createDataFrame([('he said "hi", twice', "a\\b")], "t string, u string").coalesce(1), os.path.join(tmpdir_str, "out"))
    part = [f for f in os.listdir(os.path.join(tmpdir_str, "out")) if f.endswith(".csv")][0]
    with open(os.path.join(tmpdir_str, "out", part), encoding="utf-8", newline="") as fh:
        import csv
        assert list(csv.reader(fh)) == [["t", "u"], ['he said "hi", twice', "a\\b"]]


def test_common_type_of_every_numeric_pair(spark):
    from pyspark.sql import types as T

    from aerolake.sources import common_type
    wide = {  # (narrow, wide) by what holds the values of both
        ("byte", "short"): "short", ("byte", "int"): "int", ("byte", "long"): "long", ("short", "int"): "int",
        ("short", "long"): "long", ("int", "long"): "long", ("byte", "float"): "float", ("short", "float"): "float",
        ("int", "float"): "double", ("long", "float"): "double", ("byte", "double"): "double", ("short", "double"): "double",
        ("int", "double"): "double", ("long", "double"): "double", ("float", "double"): "double",
        ("byte", "dec"): T.DecimalType(12, 2), ("short", "dec"): T.DecimalType(12, 2), ("int", "dec"): T.DecimalType(12, 2),
        ("long", "dec"): T.DecimalType(21, 2), ("float", "dec"): "double", ("double", "dec"): "double"}
    kinds = {"byte": T.ByteType(), "short": T.ShortType(), "int": T.IntegerType(), "long": T.LongType(),
             "float": T.FloatType(), "double": T.DoubleType(), "dec": T.DecimalType(12, 2)}
    for a in kinds:
        assert common_type([kinds[a], kinds[a]]) == kinds[a]
        assert common_type([kinds[a], T.NullType()]) == kinds[a]
        assert common_type([kinds[a], T.StringType()]) == T.StringType()
    for (a, b), want in wide.items():
        want = kinds.get(want, want) if isinstance(want, str) else want
        assert common_type([kinds[a], kinds[b]]) == common_type([kinds[b], kinds[a]]) == want
    assert common_type([T.DecimalType(10, 4), T.DecimalType(12, 2)]) == T.DecimalType(14, 4)


def test_first_by_key_in_source_order_over_files(spark, tmpdir_str):
    from aerolake.operators import first_by_key
    _write(os.path.join(tmpdir_str, "a.json"), '{"k": "x", "v": "first"}\n')
    _write(os.path.join(tmpdir_str, "b.json"), "".join('{"k": "x", "v": "second %d"}\n' % i for i in range(2000)))
    df = spark.read.schema("k string, v string").json(os.path.join(tmpdir_str, "*.json"))
    assert rows(first_by_key(df, "k")) == [("x", "first")]


def test_write_clean_files_follow_the_data(spark, tmpdir_str):
    from pyspark.sql import functions as F

    from aerolake.sources import write_clean
    day = F.expr(f"make_timestamp_ntz(2000 + cast(id % 4 as int), 1, 1, 0, 0, 0)")
    df = spark.range(0, 4000, numPartitions=40).select(day.alias("Partida Prevista"), "id")
    write_clean(df, os.path.join(tmpdir_str, "clean"))
    files = [f for _, _, names in os.walk(os.path.join(tmpdir_str, "clean")) for f in names if f.endswith(".parquet")]
    assert len(files) <= 8 and spark.read.parquet(os.path.join(tmpdir_str, "clean")).count() == 4000


def test_cli_run_builds_then_reports(spark, tmpdir_str):
    from aerolake.cli import main
    from aerolake.plans import testbed
    from conftest import SF001
    raw = testbed.raw_flights(spark, SF001)
    raw_path = os.path.join(tmpdir_str, "raw")
    raw.write.parquet(raw_path)
    testbed.airports(spark, SF001).coalesce(1).write.json(os.path.join(tmpdir_str, "airports"))
    airlines = os.path.join(tmpdir_str, "airlines.json")
    _write(airlines, json.dumps([r.asDict() for r in testbed.airlines(spark, SF001).collect()]))
    out = os.path.join(tmpdir_str, "report")
    clean = os.path.join(tmpdir_str, "clean")
    args = ["run", "--clean", clean, "--raw-parquet", raw_path,
            "--airports", os.path.join(tmpdir_str, "airports"), "--airports-fmt", "ndjson",
            "--airlines", airlines, "--out", out, "--statuses", "Atrasado", "--day-start", "1996-01-01"]
    assert main(args, spark) == 0
    names = sorted(os.listdir(out))
    assert {"kpis", "top_routes", "rotas", "companhias", "variacao", "missing_columns.json"} <= set(names)
    with open(os.path.join(out, "missing_columns.json"), encoding="utf-8") as fh:
        assert json.load(fh) == []
    kpis = spark.read.parquet(os.path.join(out, "kpis")).collect()[0]
    assert kpis.voos == spark.read.parquet(clean).where("`Status do Voo` = 'Atrasado' AND "
                                                        "`Partida Prevista` >= '1996-01-01'").count()
    assert main(["report", "--clean", clean, "--out", out], spark) == 0


def test_read_parquet_bytes(spark):
    import io
    import pyarrow as pa
    import pyarrow.parquet as pq
    from aerolake.sources import read_parquet_bytes
    buf = io.BytesIO()
    pq.write_table(pa.table({"Número Voo": ["0042", "0043"], "n": [1, 2]}), buf)
    df = read_parquet_bytes(spark, buf.getvalue())
    assert sorted(rows(df)) == [("0042", 1), ("0043", 2)]
