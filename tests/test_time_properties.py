"""Time semantics against an independent implementation (Python zoneinfo).

zoneinfo with fold=0 reads an ambiguous wall-clock time with the earlier
offset and a non-existent one with the offset in force before the change,
which is the contract of ``local_instant`` / ``delay_minutes``.
"""

import datetime as dt
from zoneinfo import ZoneInfo

from hypothesis import given, settings
from hypothesis import strategies as st

from aerolake.codes import LOCAL_ZONE
from aerolake.functions import delay_minutes, parse_local_time
from aerolake.functions.times import local_instant
from aerolake.operators import localise

ZONE = ZoneInfo(LOCAL_ZONE)
UTC = dt.timezone.utc

# Wall-clock times around the 1995-2019 DST changes plus plain dates.
local_times = st.datetimes(min_value=dt.datetime(1995, 1, 1), max_value=dt.datetime(2022, 12, 31))
deltas = st.integers(min_value=-6 * 3600, max_value=30 * 3600)


def expected_minutes(planned: dt.datetime, real: dt.datetime) -> int:
    a = planned.replace(tzinfo=ZONE).astimezone(UTC)
    b = real.replace(tzinfo=ZONE).astimezone(UTC)
    secs = int((b - a).total_seconds())
    return int(secs / 60)                      # truncation toward zero


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(local_times, deltas), min_size=20, max_size=60))
def test_delay_minutes_matches_zoneinfo(spark, pairs):
    rows = []
    for planned, delta in pairs:
        # The text carries no fold: an ambiguous wall clock means the earlier
        # instant (fold=0), which is the contract under test.
        planned = planned.replace(microsecond=0, fold=0)
        real = (planned + dt.timedelta(seconds=delta)).replace(fold=0)
        rows.append((planned.strftime("%Y-%m-%d %H:%M:%S"), real.strftime("%Y-%m-%d %H:%M:%S"),
                     expected_minutes(planned, real)))
    df = spark.createDataFrame(rows, "p string, r string, want long")
    got = df.select(delay_minutes(parse_local_time("p"), parse_local_time("r")).alias("got"), "want")
    bad = [r for r in got.collect() if r.got != r.want]
    assert not bad, bad[:3]


def test_instants_at_transitions(spark):
    # gap (spring forward at 00:00) and overlap (fall back at 00:00)
    cases = ["1999-10-03 00:30:00", "1999-10-03 01:30:00", "2000-02-26 23:30:00",
             "2000-02-26 22:59:59", "2000-02-27 00:00:00", "2018-11-04 00:00:00"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r[0] for r in df.select(local_instant(parse_local_time("t"))).collect()]
    want = [dt.datetime.strptime(c, "%Y-%m-%d %H:%M:%S").replace(tzinfo=ZONE)
            .astimezone(UTC).replace(tzinfo=None) for c in cases]
    assert got == want


def test_localise_instant_column(spark):
    # A TIMESTAMP (instant) column becomes the São Paulo wall clock.
    df = spark.sql("SELECT TIMESTAMP'2021-07-01 15:00:00' AS `Partida Prevista`")
    out = localise(df).collect()[0][0]
    assert out == dt.datetime(2021, 7, 1, 12, 0)


# ---- coordinates: Spark parse vs a plain statement of the rule -----------------
import re  # noqa: E402

from aerolake.functions import orient, parse_coordinates  # noqa: E402

_NUM = re.compile(r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?")


def _py_parse(text):
    if text is None:
        return None, None
    parts = re.sub(r"\s+", "", text).split(",")

    def num(i):
        if i >= len(parts) or not _NUM.fullmatch(parts[i]):
            return None
        return float(parts[i])
    return num(0), num(1)


coord_text = st.one_of(
    st.none(),
    st.text(alphabet=" ,.-+0123456789eEa\t", max_size=14),
    st.builds(lambda a, b, sep: f"{a}{sep}{b}",
              st.floats(-90, 90, allow_nan=False).map(lambda x: round(x, 4)),
              st.floats(-90, 90, allow_nan=False).map(lambda x: round(x, 4)),
              st.sampled_from([",", ", ", " , ", ",,"])),
)


@settings(max_examples=10, deadline=None)
@given(st.lists(coord_text, min_size=10, max_size=40))
def test_parse_coordinates_matches_rule(spark, texts):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    a, b = parse_coordinates(F.col("t"))
    lon, lat = orient(a, b, "lat,lon")
    got = [(r[0], r[1], r[2], r[3]) for r in df.select(a, b, lon, lat).collect()]
    for t, (ga, gb, glon, glat) in zip(texts, got):
        wa, wb = _py_parse(t)
        assert (ga, gb) == (wa, wb), (t, ga, gb, wa, wb)
        assert (glon, glat) == (wb, wa)


def test_validity_in_a_half_hour_dst_zone(spark):
    from aerolake.functions import valid_local_time
    zone = "Australia/Lord_Howe"            # clocks move by 30 minutes
    cases = ["2021-04-04 01:45:00",          # repeated (fall back 02:00 → 01:30)
             "2021-10-03 02:15:00",          # skipped (spring 02:00 → 02:30)
             "2021-04-04 01:15:00", "2021-10-03 02:45:00", "2021-07-01 12:00:00"]

    def py_valid(text):
        naive = dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")
        z = ZoneInfo(zone)
        a = naive.replace(tzinfo=z, fold=0)
        b = naive.replace(tzinfo=z, fold=1)
        round_trip = a.astimezone(UTC).astimezone(z).replace(tzinfo=None) == naive
        return round_trip and a.utcoffset() == b.utcoffset()

    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r[0] for r in df.select(valid_local_time(parse_local_time("t"), zone)).collect()]
    assert got == [py_valid(c) for c in cases] == [False, False, True, True, True]
