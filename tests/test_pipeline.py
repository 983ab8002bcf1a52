from conftest import rows
import datetime as dt

import pytest

from aerolake.codes import CODE_NOT_FOUND, JUSTIFICATIONS, LINE_TYPES
from aerolake.columns import AIRLINE_FIELDS, AIRPORT_FIELDS, CLEAN_COLUMNS, COLS, RAW_COLUMNS, string_schema
from aerolake.operators import drop_strict, first_by_key, localise
from aerolake.plans.transform import transform

AIRPORTS = [
    # icao, name, continent, country, city, gps, coords, type
    ("SBGR", "Guarulhos", "SA", "BR", "São Paulo", "SBGR", "-46.47, -23.43", "large_airport"),
    ("SBSP", "Congonhas", "SA", "BR", "São Paulo", "SBSP", "-23.62,-46.65", "medium_airport"),
    ("SBSE", "Lagoa", "SA", "BR", "Aracaju", "SBSE", "-37.07,-10.98", "seaplane_base"),
    ("SBHP", "Heliponto", "SA", "BR", "Rio", "SBHP", None, "heliport"),
    ("KJFK", "Kennedy", "NA", "US", "New York", "KJFK", "-73.77,40.64", "large_airport"),
    ("SBGR", "Second copy", "SA", "BR", "X", "X", "0,0", "small_airport"),
    (None, "No code", "SA", "BR", "Y", "Y", "0,0", "large_airport"),
]
AIRLINES = [("Gol", "GLO"), ("Azul", "AZU")]


def raw_row(n, airline="GLO", orig="SBGR", dest="SBSP", pp="2021-05-03 10:00:00",
            pr="2021-05-03 10:00:00", cp="2021-05-03 12:00:00", cr="2021-05-03 12:00:00",
            sit="REALIZADO", reason="AA", line="C"):
    return {COLS.airline_icao: airline, COLS.flight_number: f"{n:04d}", COLS.authorization: "DI",
            COLS.line_type_code: line, COLS.origin_icao: orig, COLS.dest_icao: dest,
            COLS.dep_planned: pp, COLS.dep_real: pr, COLS.arr_planned: cp, COLS.arr_real: cr,
            COLS.situation: sit, COLS.reason_code: reason}


CASES = [
    raw_row(1, pr="2021-05-03 10:20:00"),                       # departure late
    raw_row(2, cr="2021-05-03 12:05:00"),                       # arrival late
    raw_row(3, pr="2021-05-03 10:20:00", cr="2021-05-03 12:20:00"),
    raw_row(4, pr="2021-05-03 09:55:00", cr="2021-05-03 11:55:00"),  # early
    raw_row(5),                                                 # on time
    raw_row(6, sit=None), raw_row(7, sit="CANCELADO"),
    raw_row(8, pp=None), raw_row(9, pr=None), raw_row(10, cp=None), raw_row(11, cr=None),
    raw_row(12, cr="15/01/2021 10:00"),                         # malformed text: kept
    raw_row(13, reason=None), raw_row(14, reason="??"),
    raw_row(15, orig="XXXX"), raw_row(16, orig="SBHP"), raw_row(17, orig="KJFK"),
    raw_row(18, dest="XXXX"), raw_row(19, dest="SBHP"), raw_row(20, dest="KJFK"),
    raw_row(21, dest="SBSE"),                                   # seaplane kept, size ""
    raw_row(22, airline="TAM"),                                 # unmatched airline
    raw_row(23, orig=None),                                     # null key never joins
    raw_row(24, line="Z"),
]


@pytest.fixture(scope="module")
def clean(spark):
    raw = spark.createDataFrame([tuple(r[c] for c in RAW_COLUMNS) for r in CASES],
                                string_schema(RAW_COLUMNS))
    airports = spark.createDataFrame(AIRPORTS, string_schema(AIRPORT_FIELDS))
    airlines = spark.createDataFrame(AIRLINES, string_schema(AIRLINE_FIELDS))
    out = transform(raw, airports, airlines)
    return {r[COLS.flight_number]: r.asDict() for r in out.collect()}, out


def test_clean_schema(clean):
    _, df = clean
    assert sorted(df.columns) == sorted(CLEAN_COLUMNS)
    types = dict(df.dtypes)
    assert all(types[c] == "timestamp_ntz" for c in COLS.times)


def test_rows_kept_and_removed(clean):
    byno, _ = clean
    assert sorted(byno) == ["0001", "0002", "0003", "0004", "0005", "0012", "0013", "0014",
                            "0021", "0022", "0024"]


def test_late_flag(clean):
    byno, _ = clean
    status = {k: v[COLS.status] for k, v in byno.items()}
    assert [status[k] for k in ("0001", "0002", "0003", "0004", "0005")] == \
        ["Atrasado", "Atrasado", "Atrasado", "Ok", "Ok"]
    # text comparison of the unparsed value decides; the timestamp is then null
    assert byno["0012"][COLS.arr_real] is None
    assert byno["0012"][COLS.status] == "Ok"       # '15/01/2021' < '2021-05-03' as text


def test_decodes_and_lookups(clean):
    byno, _ = clean
    assert byno["0001"][COLS.reason] == JUSTIFICATIONS["AA"]
    assert byno["0013"][COLS.reason] is None
    assert byno["0014"][COLS.reason] == CODE_NOT_FOUND
    assert byno["0001"][COLS.line_type] == LINE_TYPES["C"]
    assert byno["0024"][COLS.line_type] == CODE_NOT_FOUND
    assert byno["0021"][COLS.dest_size] == ""
    assert byno["0001"][COLS.origin_size] == "Grande Porte"
    assert byno["0001"][COLS.origin_name] == "Guarulhos"        # first copy wins
    assert byno["0001"][COLS.airline] == "Gol"
    assert byno["0022"][COLS.airline] is None
    assert byno["0001"][COLS.dep_planned] == dt.datetime(2021, 5, 3, 10, 0)


def test_first_by_key_keeps_first_and_null_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 0, "y"), (None, 5, "z"), (None, 6, "w")],
                               "k string, o int, v string")
    out = sorted(first_by_key(df, "k", order_by="o").collect(), key=lambda r: str(r.k))
    assert [(r.k, r.o, r.v) for r in out] == [(None, 5, "z"), ("a", 0, "y")]


def test_drop_strict_missing_column(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        drop_strict(df, ["a", "nope"])


def test_localise_strict_raises_on_gap(spark):
    df = spark.createDataFrame([("2018-11-04 00:30:00",)], f"`{COLS.dep_planned}` string")
    assert localise(df).collect()[0][0] == dt.datetime(2018, 11, 4, 0, 30)
    with pytest.raises(Exception):
        localise(df, strict=True).collect()


def test_decode_with_code_table(spark, tmp_path):
    from aerolake.operators import decode_with_table
    from aerolake.sources import read_code_map
    p = tmp_path / "codes.json"
    p.write_text('{"C": "Regular", "N": "Charter"}', encoding="utf-8")
    df = spark.createDataFrame([("C",), ("X",), (None,)], "code string")
    out = decode_with_table(df, "code", read_code_map(spark, str(p)), "label")
    assert sorted(out.collect(), key=lambda r: (r.code is not None, r.code or "")) == \
        [(None, None), ("C", "Regular"), ("X", CODE_NOT_FOUND)]


def test_invalid_local_times_report(spark):
    from aerolake.operators import invalid_local_times
    df = spark.createDataFrame([("2018-11-04 00:30:00",), ("2021-06-01 12:00:00",), (None,)],
                               f"`{COLS.dep_planned}` string")
    bad = invalid_local_times(localise(df), [COLS.dep_planned])
    assert bad.count() == 1


def _explain(df, mode="extended") -> str:
    import io
    from contextlib import redirect_stdout
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_broadcast_choices(spark):
    from pyspark.sql import functions as F

    from aerolake.session import lookup_side, sizes
    small = spark.range(10)
    assert lookup_side(small, False) is small         # no hint: Spark's thresholds decide
    assert "BroadcastHashJoin" in _explain(spark.range(1000).join(lookup_side(small), "id"))
    assert "broadcast" not in _explain(lookup_side(spark.range(50), 100)).lower()
    # Bytes count, not rows: few rows of long text are not broadcast.
    wide = spark.range(3).withColumn("text", F.repeat(F.lit("x"), 1000))
    assert sizes([wide, small, wide.limit(0)]) == [3 * (16 + 16 + 1000), 10 * 24, 0]
    assert "broadcast" not in _explain(lookup_side(wide, 2000)).lower()


def test_code_table_with_repeated_codes(spark):
    from aerolake.operators import decode_with_table
    codes = spark.createDataFrame([("A", "first"), ("A", "second")], "code string, label string").coalesce(1)
    out = decode_with_table(spark.createDataFrame([("A",)], "c string"), "c", codes, "label")
    assert rows(out) == [("A", "first")]


def test_unparsable_times_are_counted(spark):
    from aerolake.operators import unparsable_times
    df = spark.createDataFrame([("2021-01-05 03:04:05",), ("2021-1-5 3:04:05",), ("05/01/2021 03:04",), (None,)],
                               f"`{COLS.dep_planned}` string")
    assert rows(unparsable_times(df, [COLS.dep_planned])) == [(COLS.dep_planned, 3, 2)]


def test_day_range_bounds(spark):
    import datetime as dt

    import pytest

    from aerolake.operators import FilterSpec, apply_filters
    df = spark.createDataFrame([("2021-05-31 10:00:00",)], f"`{COLS.dep_planned}` string")
    for start in (dt.datetime(2021, 5, 31), dt.datetime(2021, 5, 31, 23), dt.date(2021, 5, 31), "2021-05-31", "2021-05-31 00:00:00"):
        assert apply_filters(df, FilterSpec(day_start=start)).count() == 1
    for wrong in ("31/05/2021", "2021-05-31 soon", "2021"):
        with pytest.raises(ValueError):
            apply_filters(df, FilterSpec(day_start=wrong))
