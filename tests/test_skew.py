"""A third of all flights on one airline and one origin airport."""

from pyspark.sql import functions as F

from aerolake.columns import COLS
from aerolake.operators import delay_base, delay_by_airport, enrich_airline, kpis, top_routes
from aerolake.plans import testbed
from conftest import SF001


def skewed_raw(spark):
    raw = testbed.raw_flights(spark, SF001)
    hot = F.pmod(F.hash(F.col(f"`{COLS.flight_number}`")), F.lit(3)) == 0
    return raw.withColumns({
        COLS.airline_icao: F.when(hot, F.lit("1")).otherwise(F.col(f"`{COLS.airline_icao}`")),
        COLS.origin_icao: F.when(hot, F.lit("0")).otherwise(F.col(f"`{COLS.origin_icao}`")),
    })


def test_shuffle_join_fallback_equals_broadcast(spark):
    raw = skewed_raw(spark)
    airlines = testbed.airlines(spark, SF001)
    sel = [COLS.flight_number, COLS.airline]
    broadcast = enrich_airline(raw, airlines, broadcast=64 << 20).select(*sel)
    shuffled = enrich_airline(raw, airlines, broadcast=False).select(*sel)
    assert sorted(map(tuple, broadcast.collect())) == sorted(map(tuple, shuffled.collect()))
    hot = raw.where(F.col(f"`{COLS.airline_icao}`") == "1").count()
    assert hot * 3 >= raw.count() * 0.9


def test_aggregates_on_hot_keys_match_brute_force(spark):
    from aerolake.plans.transform import transform
    clean = transform(skewed_raw(spark), testbed.airports(spark, SF001), testbed.airlines(spark, SF001))
    pdf = clean.toPandas()
    k = kpis(clean).collect()[0]
    assert k.voos == len(pdf)
    routes = {(r.origem, r.destino): r.quantidade for r in top_routes(clean, 5).collect()}
    counts = pdf.groupby([COLS.origin_icao, COLS.dest_icao]).size()
    for key, n in routes.items():
        assert counts[key] == n
    assert max(routes.values()) == counts.max()
    base = delay_base(clean)
    by_airport = {r.aeroporto: r.quantidade_atrasos for r in delay_by_airport(base).collect()}
    bpdf = base.toPandas()
    assert by_airport == bpdf.groupby(COLS.origin_name).size().to_dict()
