"""Flight-shaped inputs derived from the TPC-H-like test tables.

``raw_flights`` gives one raw flight record per ``lineitem`` row; airports
come from ``nation`` (+ ``region``), airlines from ``supplier``. The mapping
is a test fixture (documented in FIXTURES.md §E, with the reason code taken
from the customer segment so that known, unknown and null codes all occur).
Everything is a lazy join over the whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..columns import COLS, FlightColumns
from ..session import are_small, lookup_sides

TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Airport type by nation key mod 5.
AIRPORT_TYPES = ("large_airport", "medium_airport", "small_airport", "seaplane_base", "heliport")
BR_NATIONS_BELOW = 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _scanned(df: DataFrame) -> DataFrame:
    """A table that scans as a single split (one row group) is dealt out, or one
    task would do all the work on its rows; any other is left as it scans."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism) if df.rdd.getNumPartitions() == 1 else df


def _sides(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The tables joined to ``lineitem``: orders, customers, suppliers, parts."""
    return [
        table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_custkey", "o_orderdate", (F.col("o_orderstatus") != "O").alias("o_closed")),
        table(spark, sf_dir, "customer").select(
            "c_custkey", "c_nationkey", F.upper(F.substring("c_mktsegment", 1, 2)).alias("c_reason")),
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"),
        table(spark, sf_dir, "part").select("p_partkey", F.substring("p_type", 1, 1).alias("p_line"))]


def raw_flights(spark: SparkSession, sf_dir: str, cols: FlightColumns = COLS,
                sides: list[DataFrame] | None = None) -> DataFrame:
    """One raw flight per ``lineitem`` row. Every side is broadcast only while its
    measured bytes are small (``sides``: already measured)."""
    li = _scanned(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus"))
    orders, customer, supplier, part = sides or lookup_sides(_sides(spark, sf_dir))
    j = (li.join(orders, li.l_orderkey == F.col("o_orderkey"))
           .join(customer, F.col("o_custkey") == F.col("c_custkey"))
           .join(supplier, li.l_suppkey == F.col("s_suppkey"))
           .join(part, li.l_partkey == F.col("p_partkey")))

    dep = F.timestamp_add("HOUR", F.pmod(F.col("l_partkey"), F.lit(24)).cast("int"), F.col("o_orderdate"))
    shift = F.floor(F.col("l_quantity") * 3 - 30).cast("int")
    real = F.timestamp_add("MINUTE", shift, dep)
    two_h = F.lit(2)

    return j.select(
        F.col("l_suppkey").cast("string").alias(cols.airline_icao),
        F.concat(F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.lit("-"),
                 F.col("l_orderkey").cast("string")).alias(cols.flight_number),
        F.col("l_linestatus").alias(cols.authorization),
        F.col("p_line").alias(cols.line_type_code),
        F.col("s_nationkey").cast("string").alias(cols.origin_icao),
        F.col("c_nationkey").cast("string").alias(cols.dest_icao),
        F.date_format(dep, TEXT_FORMAT).alias(cols.dep_planned),
        F.when(F.col("l_linenumber") != 7, F.date_format(real, TEXT_FORMAT)).alias(cols.dep_real),
        F.date_format(F.timestamp_add("HOUR", two_h, dep), TEXT_FORMAT).alias(cols.arr_planned),
        F.date_format(F.timestamp_add("HOUR", two_h, real), TEXT_FORMAT).alias(cols.arr_real),
        F.when(F.col("l_returnflag") == "R", "CANCELADO").otherwise("REALIZADO").alias(cols.situation),
        F.when(F.col("o_closed"), F.col("c_reason")).alias(cols.reason_code),
    )


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport records derived from ``nation``."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    k = F.col("n_nationkey")
    br = k < BR_NATIONS_BELOW
    coords = (F.when(F.pmod(k, F.lit(7)) == 6, F.lit(None).cast("string"))
               .when(F.pmod(k, F.lit(2)) == 0,
                     F.concat((F.lit(-36) - k).cast("string"), F.lit(", "), (F.lit(2) - k).cast("string")))
               .otherwise(F.concat((F.lit(2) - k).cast("string"), F.lit(","), (F.lit(-36) - k).cast("string"))))
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        k.cast("string").alias("icao_code"),
        F.col("n_name").alias("name"),
        F.when(br, "SA").otherwise("NA").alias("continent"),
        F.when(br, "BR").otherwise("US").alias("iso_country"),
        F.col("r_name").alias("municipality"),
        F.concat(F.lit("SB"), F.lpad(k.cast("string"), 2, "0")).alias("gps_code"),
        coords.alias("coordinates"),
        F.element_at(F.array(*[F.lit(t) for t in AIRPORT_TYPES]),
                     (F.pmod(k, F.lit(5)) + 1).cast("int")).alias("type"),
    )


def airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airline records derived from ``supplier`` (those above a balance, so that some flights stay unmatched)."""
    return table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 500) \
        .select(F.col("s_name").alias("Nome"), F.col("s_suppkey").cast("string").alias("Sigla"))


def events_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` stream table with its local calendar parts."""
    from ..functions.times import calendar_parts
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return ev.withColumns(calendar_parts(F.col("ts")))


def clean_flights(spark: SparkSession, sf_dir: str, parse_times: bool = True) -> DataFrame:
    """The clean flights, built from the given tables; all lookups are measured in one job."""
    from .transform import transform
    sides = [*_sides(spark, sf_dir), airports(spark, sf_dir), airlines(spark, sf_dir)]
    small = are_small(sides)
    raw = raw_flights(spark, sf_dir, sides=[F.broadcast(df) if ok else df for df, ok in zip(sides[:4], small)])
    return transform(raw, *sides[4:], parse_times=parse_times, broadcast=tuple(small[4:]))
