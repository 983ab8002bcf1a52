"""

Each query reads the whole test tables of ``sf_dir`` each time and derives the
flight-shaped inputs from them (see ``aerolake.plans.testbed``); nothing is
stored between queries, and nothing is sampled or capped except where a limit
is the feature itself (top-k views, the 1,000-row sample, the 20,000-value
selection lists).
"""

from __future__ import annotations

import importlib.util
import os
import sys
import uuid
from collections.abc import Callable
from contextlib import contextmanager

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from aerolake.codes import LINE_TYPES, UNIQUE_VALUES_LIMIT  # noqa: E402
from aerolake.columns import AIRPORT_FIELDS, COLS, missing_columns, to_ascii_names  # noqa: E402
from aerolake.functions.geo import in_box, with_lon_lat  # noqa: E402
from aerolake.operators import (  # noqa: E402
    FilterSpec, apply_filters, completed_flights, date_bounds, day_condition, decode_codes, decode_with_table, delay_base,
    delay_by_airline, delay_by_airport, delay_by_period, delay_by_weekday, delay_by_year,
    domestic_only, enrich_airline, enrich_airports, filter_options, first_by_key, flights_per_day,
    invalid_local_times, kpis, late_flag, localise, route_intensity, route_map, route_nodes,
    sample_rows, status_distribution, top_airlines_per_year, top_routes, unique_values, unparsable_times,
    yoy_decreases, yoy_increases, yoy_variation, yoy_variation_with_fallback)
from aerolake.operators.quantiles import exact_quantiles  # noqa: E402
from aerolake.plans import ResultCatalogue, load_or_build, report, run_batch, testbed  # noqa: E402
from aerolake.plans.report import map_input  # noqa: E402
from aerolake.session import ensure_checkpoint_dir  # noqa: E402
from aerolake.sources import (YEAR_PARTITION, csv_to_ndjson, export_csv, export_parquet, head_in_source_order,  # noqa: E402
                              read_code_map, read_csv, read_flights_csv, read_lookup_records, read_parquet,
                              read_parquet_bytes, read_parquet_relaxed, union_relaxed, write_clean)
from aerolake.sources.files import list_files  # noqa: E402
from aerolake.streaming import compact, read_rollups, rollup_report, stream_rollups  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

# Filter used by the filter_* queries (same values in sql_oracle.FILTER_WHERE).
FILTER_SPEC = FilterSpec(
    statuses=("Atrasado",),
    line_types=(LINE_TYPES["P"], LINE_TYPES["E"]),
    origin_icao=("0", "1", "2", "3", "5", "6"),
    day_start="1996-03-01",
    day_end="1997-06-30",
)

# The report query's filter, and what it compares of each output.
REPORT_SPEC = FilterSpec(situations=("REALIZADO",), day_start="1995-06-01", day_end="1995-12-31")
REPORT_COLUMNS = {
    "kpis": (["voos"], ["empresas", "rotas"]),
    "per_day": (["dia"], ["voos"]),
    "status": (["status"], ["quantidade"]),
    "top_routes": (["origem", "destino"], ["quantidade"]),
    "sample": (["numero_voo"], ["partida_prevista"]),
    "aeroportos": (["aeroporto"], ["quantidade_atrasos"]),
    "variacao": (["aeroporto"], ["y_prev", "y_curr", "delta", "usou_fallback"]),
    "aumentos": (["aeroporto"], ["delta"]),
    "quedas": (["aeroporto"], ["delta"]),
    "por_ano": (["ano"], ["quantidade_atrasos"]),
    "dias_semana": (["ano", "dia"], ["quantidade_atrasos"]),
    "periodos": (["ano", "periodo"], ["quantidade_atrasos"]),
    "companhias_por_ano": (["ano", "empresa"], ["quantidade_atrasos"]),
    "companhias": (["ano", "empresa"], ["quantidade_atrasos"]),
    "rotas": (["origem_lon", "origem_lat", "destino_lon", "destino_lat"], ["quantidade", "atraso_medio"]),
    "nos": (["lon", "lat"], ["quantidade"]),
    "intensidade": (["origem_lon", "origem_lat", "destino_lon", "destino_lat"], ["intensidade"]),
}
# Quotients are compared with six decimals.
QUOTIENTS = ("atraso_medio", "intensidade")


# ---------------------------------------------------------------- inputs
def _raw(spark, d):
    return testbed.raw_flights(spark, d)


def _clean(spark, d, parse_times=True):
    return testbed.clean_flights(spark, d, parse_times)


def _rows(df: DataFrame) -> DataFrame:
    return to_ascii_names(df)


def _base(spark, d, limit=15):
    return delay_base(_clean(spark, d), limit)


def _with_bad_times(raw: DataFrame) -> DataFrame:
    """Malformed time text on some rows, chosen by their own attributes
    (day-first text, fractional seconds, date only)."""
    lt, auth = F.col(f"`{COLS.line_type_code}`"), F.col(f"`{COLS.authorization}`")
    out = {}
    for name in COLS.times:
        c = F.col(f"`{name}`")
        out[name] = (F.when(lt == "L", F.concat(F.substring(c, 9, 2), F.lit("/"), F.substring(c, 6, 2),
                                                F.lit("/"), F.substring(c, 1, 4), F.lit(" "),
                                                F.substring(c, 12, 5)))
                      .when((lt == "E") & (auth == "F"), F.concat(c, F.lit(".5")))
                      .when((lt == "S") & (auth == "O"), F.substring(c, 1, 10))
                      .otherwise(c))
    return raw.withColumns(out)


def _routes(spark, d):
    return route_map(_base(spark, d), "auto", 1000, True)


# ---------------------------------------------------------------- queries
def q_airport_enrich(spark, d):
    return to_ascii_names(enrich_airports(_raw(spark, d), testbed.airports(spark, d)))


def q_airline_enrich(spark, d):
    return to_ascii_names(enrich_airline(_raw(spark, d), testbed.airlines(spark, d)))


def q_first_by_key(spark, d):
    customer = testbed.table(spark, d, "customer").select(
        "c_mktsegment", "c_custkey", "c_name", "c_nationkey", "c_acctbal")
    return first_by_key(customer, "c_mktsegment", order_by="c_custkey")


def q_decode_codes(spark, d):
    out = decode_codes(_raw(spark, d))
    return to_ascii_names(out.select(COLS.flight_number, COLS.reason_code, COLS.reason,
                                     COLS.line_type_code, COLS.line_type))


def q_completed_flights(spark, d):
    return to_ascii_names(completed_flights(_raw(spark, d)))


def q_domestic_only(spark, d):
    out = domestic_only(enrich_airports(_raw(spark, d), testbed.airports(spark, d)))
    return to_ascii_names(out.select(COLS.flight_number, COLS.origin_icao, COLS.dest_icao,
                                     COLS.origin_country, COLS.dest_country))


def q_late_flag(spark, d):
    out = late_flag(_raw(spark, d))
    return to_ascii_names(out.select(COLS.flight_number, *COLS.times, COLS.status))


def q_localise_times(spark, d):
    out = localise(_with_bad_times(_raw(spark, d)).select(COLS.flight_number, *COLS.times))
    return to_ascii_names(out)


def q_clean_flights(spark, d):
    return _rows(_clean(spark, d))


def q_union_relaxed(spark, d):
    customer = testbed.table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"), F.col("c_mktsegment").alias("code"))
    supplier = testbed.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"),
        F.col("s_nationkey").alias("code"))
    return union_relaxed([customer, supplier])


def q_filter_flights(spark, d):
    return _rows(apply_filters(_clean(spark, d), FILTER_SPEC))


def q_filter_flights_text(spark, d):
    return to_ascii_names(apply_filters(_clean(spark, d, parse_times=False), FILTER_SPEC))


def q_flights_per_day(spark, d):
    return flights_per_day(_clean(spark, d))


def q_flights_per_day_text(spark, d):
    return flights_per_day(_clean(spark, d, parse_times=False))


def q_events_per_day(spark, d):
    return flights_per_day(testbed.table(spark, d, "events"), column="ts")


def q_status_distribution(spark, d):
    return status_distribution(_clean(spark, d))


def q_top_routes(spark, d):
    return top_routes(_clean(spark, d), 20)


def q_kpis(spark, d):
    return kpis(_clean(spark, d))


def q_unique_values(spark, d):
    return unique_values(_clean(spark, d), COLS.airline, UNIQUE_VALUES_LIMIT)


def q_unique_values_all(spark, d):
    return unique_values(_clean(spark, d), COLS.airline)


# The six filter lists of the dashboard sidebar.
FILTER_COLUMNS = (COLS.airline, COLS.situation, COLS.status, COLS.line_type,
                  COLS.origin_name, COLS.dest_name)


def q_filter_options(spark, d):
    return filter_options(_clean(spark, d), FILTER_COLUMNS, UNIQUE_VALUES_LIMIT)


def q_date_bounds(spark, d):
    return date_bounds(_clean(spark, d), COLS.dep_planned)


def q_sample_rows(spark, d):
    return _rows(sample_rows(_clean(spark, d), [COLS.dep_planned, COLS.flight_number], 1000))


def q_delay_base(spark, d):
    return _rows(_base(spark, d))


def q_delay_by_airport(spark, d):
    return delay_by_airport(_base(spark, d), 25)


def q_delay_by_year(spark, d):
    return delay_by_year(_base(spark, d))


def q_delay_by_weekday(spark, d):
    return delay_by_weekday(_base(spark, d))


def q_delay_by_period(spark, d):
    return delay_by_period(_base(spark, d))


def q_events_by_period(spark, d):
    return delay_by_period(testbed.events_calendar(spark, d))


def q_delay_by_airline(spark, d):
    return delay_by_airline(_base(spark, d))


def q_top_airlines_per_year(spark, d):
    return top_airlines_per_year(_base(spark, d), 15)


def q_yoy_variation(spark, d):
    return yoy_variation(_base(spark, d))


def q_yoy_increases(spark, d):
    return yoy_increases(yoy_variation(_base(spark, d)), 10)


def q_yoy_decreases(spark, d):
    return yoy_decreases(yoy_variation(_base(spark, d)), 10)


def _yoy_in(spark, d, first_day, last_day):
    undated = _base(spark, d)
    days = FilterSpec(day_start=first_day, day_end=last_day)
    return yoy_variation_with_fallback(undated, day_condition(undated, days))


def q_yoy_fallback(spark, d):
    """One year only: the day range is dropped."""
    return _yoy_in(spark, d, "2000-01-01", "2000-12-31")


def q_yoy_no_fallback(spark, d):
    """A day range over three years keeps to its two latest."""
    return _yoy_in(spark, d, "1994-07-01", "1996-03-31")


def q_coord_orient(spark, d):
    out = _clean(spark, d).select(F.col(f"`{COLS.flight_number}`").alias("numero_voo"),
                                  F.col(f"`{COLS.origin_coords}`").alias("coordenadas_origem"))
    for fmt, tag in (("auto", "auto"), ("lat,lon", "latlon"), ("lon,lat", "lonlat")):
        out = with_lon_lat(out, "coordenadas_origem", f"lon_{tag}", f"lat_{tag}", fmt)
    return out.withColumn("valido", in_box(F.col("lon_auto"), F.col("lat_auto")))


def q_invalid_local_times(spark, d):
    """Raw flights with a wall-clock time that does not exist or is ambiguous
    in the local zone (the rows a strict localisation rejects)."""
    raw = localise(_raw(spark, d).select(COLS.flight_number, *COLS.times))
    return to_ascii_names(invalid_local_times(raw, COLS.times))


def q_unparsable_times(spark, d):
    return unparsable_times(_with_bad_times(_raw(spark, d)))


def q_missing_columns(spark, d):
    """The expected columns that the raw records lack, and what the guarded
    operators answer without theirs: nothing, in the declared types."""
    raw = _raw(spark, d).drop(COLS.dep_real)
    names = [F.lit(c) for c in missing_columns(raw)]
    lacking = raw.agg(F.count("*").alias("voos")).select("voos", F.explode(F.array(*names)).alias("coluna"))
    late = delay_by_airport(delay_base(raw, 15)).agg(F.count("*").alias("atrasos")).scalar()
    return lacking.select("coluna", "voos", late.alias("atrasos"))


def q_status_by_situation(spark, d):
    """Without the late status, flights are counted by situation."""
    return status_distribution(_raw(spark, d))


def q_route_map_input(spark, d):
    """Route map when the delay base is empty (threshold at the 180-minute
    maximum): the map falls back to all filtered flights, counts only."""
    clean = _clean(spark, d)
    return route_map(map_input(delay_base(clean, 180), clean), "auto", 1000, True)


def q_route_map_base(spark, d):
    """Route map when the delay base has rows: late flights, with mean delays."""
    clean = _clean(spark, d)
    return route_map(map_input(delay_base(clean, 15), clean), "auto", 1000, True)


def q_route_map(spark, d):
    return _routes(spark, d)


def q_route_map_all(spark, d):
    return route_map(_base(spark, d), "auto", None, True)


def q_route_nodes(spark, d):
    return route_nodes(_routes(spark, d))


def q_route_intensity(spark, d):
    # The routes are few and read twice: for their percentiles, then scaled.
    ensure_checkpoint_dir(spark, None if spark.conf.get("spark.checkpoint.dir", None) else _local_folder())
    out = route_intensity(_routes(spark, d).checkpoint())
    return out.withColumn("intensidade", F.round("intensidade", 6))


def _report_rows(out: dict) -> DataFrame:
    """Every output of a report as rows ``(nome, chave, valor)``."""
    def text(cols):
        return F.concat_ws("|", *[F.coalesce((F.col(c).cast("decimal(18,6)") if c in QUOTIENTS else F.col(c)).cast("string"), F.lit("-"))
                                  for c in cols])
    rows = None
    for name, (keys, values) in REPORT_COLUMNS.items():
        if name in out:
            df = to_ascii_names(out[name])
            part = df.select(F.lit(name).alias("nome"), text(keys).alias("chave"), text(values).alias("valor"))
            rows = part if rows is None else rows.unionByName(part)
    return rows


def _clean_table(spark, d) -> DataFrame:
    """The clean table, written once under the shared folder and read back."""
    path = _folder(spark, "clean")
    write_clean(_clean(spark, d), path, partition_by_year=False)
    return spark.read.parquet(path)


def q_report(spark, d):
    """Every output of the report over a published clean table."""
    return _report_rows(report(_clean_table(spark, d), REPORT_SPEC, persist=False))


def q_report_reuse(spark, d):
    """A second report over the same clean table: every output comes from what the
    first one stored."""
    clean, store = _clean_table(spark, d), ResultCatalogue(spark, _folder(spark, "results"))
    report(clean, REPORT_SPEC, store=store)
    built = len(store.stored)
    out = report(clean, REPORT_SPEC, store=store)
    reused = len(store.hits) == built == len(store.stored) and not store.skipped
    return _report_rows(out).withColumn("reutilizado", F.lit(reused))


# Flights of an extract, about 75 MB of text.
EXTRACT_ROWS = 1_000_000


def q_report_incremental(spark, d):
    """The report of a range of days from aggregates that a file stream keeps: four
    extracts, or more of bounded size, half of them a batch, added up into a base and read."""
    folder = _folder(spark, "rollups")
    raw = _raw(spark, d)
    extracts = max(4, -(-testbed.table(spark, d, "lineitem").count() // EXTRACT_ROWS))
    raw.repartitionByRange(extracts, f"`{COLS.flight_number}`").write.option("header", True).option("sep", ";").option("escape", '"') \
        .csv(f"{folder}/extracts")
    half = -(-len(list_files(spark, f"{folder}/extracts")) // 2)
    stream_rollups(spark, f"{folder}/extracts", raw.columns, testbed.airports(spark, d), testbed.airlines(spark, d),
                   f"{folder}/store", f"{folder}/log", name=f"rollups-{uuid.uuid4().hex}", files_per_batch=half or None).awaitTermination()
    compact(spark, f"{folder}/store")
    days = FilterSpec(day_start=REPORT_SPEC.day_start, day_end=REPORT_SPEC.day_end)
    return _report_rows(rollup_report(read_rollups(spark, f"{folder}/store"), days))


def q_airline_enrich_hot(spark, d):
    """A third of all flights by one airline, joined with a lookup that counts as
    too large to broadcast."""
    raw = _raw(spark, d)
    hot = F.substring(F.col(f"`{COLS.flight_number}`"), 4, 20).cast("long") % 3 == 0
    raw = raw.withColumn(COLS.airline_icao, F.when(hot, F.lit("1")).otherwise(F.col(f"`{COLS.airline_icao}`")))
    return to_ascii_names(enrich_airline(raw, testbed.airlines(spark, d), broadcast=0))


def q_route_intensity_all(spark, d):
    """All routes, their percentiles found by ranks."""
    path = _folder(spark, "routes")
    q_route_map_all(spark, d).write.parquet(path)
    out = route_intensity(spark.read.parquet(path), unlimited=True)
    return out.withColumn("intensidade", F.round("intensidade", 6))


DELAY_SHARES = (0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0)


def q_delay_quantiles(spark, d):
    """Quantiles of the delays of all late flights, and of their mean speed over the
    planned day (many different values)."""
    path = _folder(spark, "delays")
    _base(spark, d).select("atraso_min", (F.col("atraso_min") / (F.col("hora") + 1)).alias("por_hora")).write.parquet(path)
    delays = spark.read.parquet(path)
    found = {c: exact_quantiles(delays, c, DELAY_SHARES) for c in delays.columns}
    row = lambda c, p, v: F.struct(F.lit(c).alias("medida"), F.lit(p).alias("parte"), F.round(F.lit(v).cast("double"), 6).alias("valor"))
    return delays.limit(1).select(F.inline(F.array(*[row(c, p, v) for c, vs in found.items() for p, v in zip(DELAY_SHARES, vs)])))


# ---------------------------------------------------------------- round trips through files
def _local_folder() -> str:
    """For a local session without a shared folder (tests)."""
    import tempfile
    if not SparkSession.getActiveSession().sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir is not set")
    return tempfile.mkdtemp(prefix="aerolake-")


def _folder(spark, name):
    root = ensure_checkpoint_dir(spark, None if spark.conf.get("spark.checkpoint.dir", None) else _local_folder())
    return f"{root.rstrip('/')}/round-trips/{name}-{uuid.uuid4().hex}"


def _awkward(raw: DataFrame) -> DataFrame:
    """Quotes, separators, line breaks and accents in the airline code of some rows."""
    line, code = F.col(f"`{COLS.line_type_code}`"), F.col(f"`{COLS.airline_icao}`")
    return raw.withColumn(COLS.airline_icao,
                          F.when(line == "L", F.concat(F.lit('x "y"; '), code))
                           .when(line == "E", F.concat(code, F.lit("\nlinha 2 é, ç")))
                           .when(line == "S", F.concat(F.lit('"'), code)).otherwise(code))


def q_csv_roundtrip(spark, d):
    """Raw records written as two CSV extracts with different headers, one in
    another column order and without the reason, and read back together."""
    raw, folder = _awkward(_raw(spark, d)), _folder(spark, "extracts")
    done = F.col(f"`{COLS.situation}`") == "REALIZADO"
    export_csv(raw.where(done), f"{folder}/a", sep=";")
    export_csv(raw.where(~done).drop(COLS.reason_code).select(*reversed([c for c in raw.columns if c != COLS.reason_code])),
               f"{folder}/b", sep=";")
    return to_ascii_names(read_flights_csv(spark, f"{folder}/*/part-*", multi_line=True))


def q_csv_export(spark, d):
    """The clean table's text export, comma-separated, read back."""
    path = _folder(spark, "export")
    export_csv(_awkward(_clean(spark, d, parse_times=False).withColumn(COLS.line_type_code, F.substring(COLS.line_type, 1, 1))), path)
    return to_ascii_names(read_csv(spark, path, multi_line=True)).drop("codigo_tipo_linha")


def q_ndjson_roundtrip(spark, d):
    """A CSV export with line breaks in quotes turned into compressed JSON lines and read back."""
    folder = _folder(spark, "ndjson")
    raw = _awkward(_raw(spark, d))
    export_csv(raw, f"{folder}/csv")
    csv_to_ndjson(spark, f"{folder}/csv", f"{folder}/json", compression="gzip")
    return to_ascii_names(read_lookup_records(spark, f"{folder}/json", raw.columns, "ndjson"))


def _write_arrays(records: DataFrame, key: str, path: str) -> str:
    """Records as files of one JSON array each, about a thousand records a file."""
    arrays = records.groupBy(F.floor(F.col(key).cast("long") / 1000).alias("bloco")).agg(
        F.to_json(F.sort_array(F.collect_list(F.struct(*records.columns))), {"ignoreNullFields": "false"}).alias("value"))
    arrays.repartition("bloco").write.partitionBy("bloco").text(path)
    return f"{path}/*/*"


def q_lookup_records(spark, d):
    """A record per supplier with its airport's fields, as JSON arrays, read back and
    made unique."""
    ports = testbed.airports(spark, d).select(*AIRPORT_FIELDS)
    supplier = testbed.table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("icao_code"))
    records = supplier.join(ports, "icao_code").select(
        F.col("s_suppkey").cast("string").alias("icao_code"), *[c for c in AIRPORT_FIELDS if c != "icao_code"])
    files = _write_arrays(records, "icao_code", _folder(spark, "airports"))
    return first_by_key(read_lookup_records(spark, files, AIRPORT_FIELDS, "array"), "icao_code")


def q_code_map(spark, d):
    """A JSON object of codes, written from the nations, decoding customers."""
    path = _folder(spark, "codes")
    nation = testbed.table(spark, d, "nation").where("n_nationkey % 3 <> 0")
    nation.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(
        F.col("n_nationkey").cast("string"), F.col("n_name"))))).alias("value")).write.text(path)
    customer = testbed.table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("codigo"))
    return decode_with_table(customer, "codigo", read_code_map(spark, path), "rotulo")


def q_first_by_key_source_order(spark, d):
    """The first record of a key over several files: files by name, then rows in order."""
    path = _folder(spark, "ordered")
    customer = testbed.table(spark, d, "customer").select("c_mktsegment", "c_custkey")
    for name, part in (("a", customer.where("c_custkey % 3 = 0")), ("b", customer.where("c_custkey % 3 <> 0"))):
        part.repartitionByRange("c_custkey").sortWithinPartitions("c_custkey").write.json(f"{path}/{name}")
    return first_by_key(spark.read.schema("c_mktsegment string, c_custkey long").json(f"{path}/*"), "c_mktsegment")


def q_batch_publish(spark, d):
    """The batch job from files: CSV extracts and JSON lookups in, the clean
    table written by year, read back."""
    folder = _folder(spark, "batch")
    export_csv(_raw(spark, d), f"{folder}/extracts", sep=";")
    testbed.airports(spark, d).write.json(f"{folder}/airports")
    airlines = _write_arrays(testbed.airlines(spark, d), "Sigla", f"{folder}/airlines")
    clean = run_batch(spark, out_path=f"{folder}/clean", csv_glob=f"{folder}/extracts/part-*",
                      airports_path=f"{folder}/airports", airlines_path=airlines, airports_fmt="ndjson")
    return to_ascii_names(load_or_build(spark, f"{folder}/clean") if clean.columns else clean)


def q_sample_source_order(spark, d):
    """The first customers with a debit in the order of the files, of which only the
    first are read."""
    path = _folder(spark, "sample")
    testbed.table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal") \
        .repartitionByRange(16, "c_custkey").sortWithinPartitions("c_custkey").write.parquet(path)
    return head_in_source_order(spark.read.parquet(path), 40, F.col("c_acctbal") < 0)


def q_clean_clustered(spark, d):
    """A clean table clustered by origin and airline, filtered by lists of both."""
    path = _folder(spark, "clustered")
    write_clean(_clean(spark, d), path, cluster_by=(COLS.origin_icao, COLS.airline_icao))
    lists = FilterSpec(origin_icao=("3", "7"), line_types=(LINE_TYPES["P"], LINE_TYPES["E"]), day_start="1996-03-01")
    return to_ascii_names(apply_filters(spark.read.parquet(path), lists, year_col=YEAR_PARTITION)).drop(YEAR_PARTITION)


def q_parquet_export(spark, d):
    """The filtered flights exported as Parquet and read back."""
    path = _folder(spark, "export-parquet")
    export_parquet(apply_filters(_clean(spark, d), FILTER_SPEC), path)
    return to_ascii_names(read_parquet(spark, path))


def q_parquet_bytes(spark, d):
    """A Parquet file handed over as bytes, as an upload is: customers counted by
    nation and segment (few rows, whatever the number of customers)."""
    path = _folder(spark, "upload")
    testbed.table(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n")) \
        .coalesce(1).write.parquet(path)
    content = spark.read.format("binaryFile").load(f"{path}/part-*").select("content").first()[0]
    return read_parquet_bytes(spark, bytes(content))


def q_parquet_drift(spark, d):
    """Extracts of the orders whose columns and types changed over the years: whole
    and broken keys, a priority only later, a status that was a number."""
    path = _folder(spark, "drift")
    orders = testbed.table(spark, d, "orders")
    key, year = F.col("o_orderkey"), F.year("o_orderdate")
    parts = {
        "a": orders.where(year < 1994).select(key.cast("int").alias("chave"), F.col("o_totalprice").cast("int").alias("total")),
        "b": orders.where((year >= 1994) & (year < 1997)).select(
            key.alias("chave"), F.col("o_totalprice").alias("total"), (key % 3).alias("situacao")),
        "c": orders.where(year >= 1997).select(
            key.alias("chave"), F.col("o_totalprice").alias("total"), F.col("o_orderstatus").alias("situacao"),
            F.col("o_orderpriority").alias("prioridade"))}
    for name, part in parts.items():
        part.write.parquet(f"{path}/{name}")
    return read_parquet_relaxed(spark, path)


def q_union_relaxed_numeric(spark, d):
    """Columns of several numeric types, widened without loss."""
    customer = testbed.table(spark, d, "customer").select(
        F.col("c_custkey").cast("int").alias("a"), F.col("c_custkey").alias("b"), F.col("c_acctbal").cast("decimal(12,2)").alias("c"),
        F.col("c_nationkey").cast("int").alias("e"))
    supplier = testbed.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("a"), F.col("s_acctbal").cast("float").alias("b"), F.col("s_nationkey").cast("int").alias("c"),
        F.col("s_acctbal").cast("double").alias("e"))
    return union_relaxed([customer, supplier])


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "airport_enrich": q_airport_enrich,
    "airline_enrich": q_airline_enrich,
    "first_by_key": q_first_by_key,
    "decode_codes": q_decode_codes,
    "completed_flights": q_completed_flights,
    "domestic_only": q_domestic_only,
    "late_flag": q_late_flag,
    "localise_times": q_localise_times,
    "clean_flights": q_clean_flights,
    "union_relaxed": q_union_relaxed,
    "union_relaxed_numeric": q_union_relaxed_numeric,
    "filter_flights": q_filter_flights,
    "filter_flights_text": q_filter_flights_text,
    "flights_per_day": q_flights_per_day,
    "flights_per_day_text": q_flights_per_day_text,
    "events_per_day": q_events_per_day,
    "status_distribution": q_status_distribution,
    "status_by_situation": q_status_by_situation,
    "top_routes": q_top_routes,
    "kpis": q_kpis,
    "unique_values": q_unique_values,
    "unique_values_all": q_unique_values_all,
    "filter_options": q_filter_options,
    "date_bounds": q_date_bounds,
    "sample_rows": q_sample_rows,
    "delay_base": q_delay_base,
    "delay_by_airport": q_delay_by_airport,
    "delay_by_year": q_delay_by_year,
    "delay_by_weekday": q_delay_by_weekday,
    "delay_by_period": q_delay_by_period,
    "events_by_period": q_events_by_period,
    "delay_by_airline": q_delay_by_airline,
    "top_airlines_per_year": q_top_airlines_per_year,
    "yoy_variation": q_yoy_variation,
    "yoy_increases": q_yoy_increases,
    "yoy_decreases": q_yoy_decreases,
    "yoy_fallback": q_yoy_fallback,
    "yoy_no_fallback": q_yoy_no_fallback,
    "coord_orient": q_coord_orient,
    "invalid_local_times": q_invalid_local_times,
    "unparsable_times": q_unparsable_times,
    "missing_columns": q_missing_columns,
    "route_map_input": q_route_map_input,
    "route_map_base": q_route_map_base,
    "route_map": q_route_map,
    "route_map_all": q_route_map_all,
    "route_nodes": q_route_nodes,
    "route_intensity": q_route_intensity,
    "report": q_report,
    "csv_roundtrip": q_csv_roundtrip,
    "csv_export": q_csv_export,
    "ndjson_roundtrip": q_ndjson_roundtrip,
    "lookup_records": q_lookup_records,
    "code_map": q_code_map,
    "first_by_key_source_order": q_first_by_key_source_order,
    "batch_publish": q_batch_publish,
    "report_reuse": q_report_reuse,
    "report_incremental": q_report_incremental,
    "airline_enrich_hot": q_airline_enrich_hot,
    "route_intensity_all": q_route_intensity_all,
    "delay_quantiles": q_delay_quantiles,
    "sample_source_order": q_sample_source_order,
    "clean_clustered": q_clean_clustered,
    "parquet_export": q_parquet_export,
    "parquet_bytes": q_parquet_bytes,
    "parquet_drift": q_parquet_drift,
}


@contextmanager
def _utc(spark: SparkSession):
    """Wall-clock semantics are defined under a UTC session zone. Plans take the
    zone up while they are built, so the caller's is put back afterwards."""
    key = "spark.sql.session.timeZone"
    old = spark.conf.get(key)
    spark.conf.set(key, "UTC")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the routes with most completed domestic flights (sf0.001)."""
    with _utc(spark):
        return q_top_routes(spark, SMOKE_DIR)


def _installed(module: str) -> bool:
    """Whether an optional part of the library is there (it may be left out whole)."""
    spec = importlib.util.find_spec(module)
    return spec is not None and spec.origin is not None


def _all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = dict(_QUERIES)
    if _installed("aerolake.llm"):
        from aerolake.llm.queries import QUERIES
        out.update(QUERIES)
        if _installed("corpus_pipeline"):
            import corpus_pipeline
            out["pipeline"] = corpus_pipeline.run
    return out


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with _utc(spark):
                return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        return run
    return {name: bind(fn) for name, fn in _all_queries().items()}


def oracle_sql() -> dict[str, str]:
    from sql_oracle import oracle_sql as _sql
    sql = _sql()
    out = {k: sql[k] for k in _QUERIES if k in sql}
    if _installed("aerolake.llm"):
        from aerolake.llm.queries import SQL
        out.update(SQL)
        if _installed("corpus_pipeline"):
            import corpus_pipeline
            if corpus_pipeline.ORACLE_SQL:
                out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
