"""Time semantics.

Local wall-clock times are kept as ``TIMESTAMP_NTZ`` (calendar parts are read
from them directly); elapsed time is measured between UTC instants obtained
with ``convert_timezone`` so that a DST change between two events is counted
in real minutes. Non-existent local times (DST gap) move forward, ambiguous
ones (DST overlap) take the earlier instant.
"""

from __future__ import annotations

import datetime as dt
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..codes import LOCAL_ZONE, TIME_TEXT_PATTERN


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_local_time(text: Column | str, pattern: str = TIME_TEXT_PATTERN) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` text → TIMESTAMP_NTZ; any other text → null.

    The regex guard is needed because ``try_cast`` alone also accepts a bare
    date or fractional seconds.
    """
    t = _c(text)
    return F.when(t.rlike(pattern), t.try_cast("timestamp_ntz"))


_UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "UTC+00:00"}


def _session_is_utc() -> bool:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark is not None and spark.conf.get("spark.sql.session.timeZone") in _UTC_NAMES


def local_instant(ts: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """Local wall clock in ``zone`` → UTC instant (as TIMESTAMP_NTZ in UTC).

    Under a UTC session (the setting of this library) the instant comes from
    ``to_utc_timestamp`` on the wall clock, whose literal zone is resolved
    once per task in generated code; ``convert_timezone`` resolves both zone
    names on every row and costs about 6x more. Both apply the same rules
    (gap → forward, overlap → earlier instant). Other session zones use
    ``convert_timezone``, which does not depend on the session.
    """
    t = _c(ts)
    if _session_is_utc():
        return F.to_utc_timestamp(t.cast("timestamp"), zone).cast("timestamp_ntz")
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), t)


def utc_to_local(instant: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """UTC instant (TIMESTAMP_NTZ in UTC) → wall clock in ``zone``."""
    u = _c(instant)
    if _session_is_utc():
        return F.from_utc_timestamp(u.cast("timestamp"), zone).cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), u)


# Sizes of real-world clock changes (most zones 1 h; a few 30 min or 2 h).
CLOCK_SHIFTS_MINUTES = (30, 60, 120)
LAST_YEAR = 2100


@lru_cache(maxsize=32)
def clock_change_days(zone: str = LOCAL_ZONE) -> tuple[dt.date, ...]:
    """The local days on which the clocks of ``zone`` change, from Spark's own
    zone rules (the recurring ones up to ``LAST_YEAR``)."""
    from pyspark.sql import SparkSession
    rules = SparkSession.getActiveSession()._jvm.java.time.ZoneId.of(zone).getRules()
    changes = list(rules.getTransitions())
    while changes and (after := rules.nextTransition(changes[-1].getInstant())) is not None \
            and after.getDateTimeBefore().getYear() <= LAST_YEAR:
        changes.append(after)
    days = {dt.date.fromisoformat(t.toLocalDate().toString())
            for c in changes for t in (c.getDateTimeBefore(), c.getDateTimeAfter())}
    # An overlap that ends at midnight lies on the day before.
    return tuple(sorted(days | {d - dt.timedelta(days=1) for d in days}))


def valid_local_time(ts: Column | str, zone: str = LOCAL_ZONE,
                     shifts_minutes=CLOCK_SHIFTS_MINUTES) -> Column:
    """False for a wall-clock time that does not exist (gap) or occurs twice
    (overlap) in ``zone``; null for null.

    Only times on a day of a clock change are looked at closely, the others are
    told by a set of days. A gap time does not survive the round trip local →
    UTC → local. An ambiguous time maps to its earlier instant ``u``; ``u`` plus
    the size of the clock change shows the same wall clock again, which never
    happens for an ordinary time.
    """
    t = _c(ts)
    days = clock_change_days(zone)
    if not days:
        return F.when(t.isNotNull(), F.lit(True))
    u = local_instant(t, zone)
    ok = utc_to_local(u, zone) == t
    for m in shifts_minutes:
        ok = ok & (utc_to_local(u + F.expr(f"INTERVAL {int(m)} MINUTES"), zone) != t)
    return ~F.to_date(t).isin(list(days)) | ok


def delay_minutes(planned: Column | str, real: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """Whole minutes ``real - planned`` (truncated toward zero) in real time."""
    return F.timestamp_diff("MINUTE", local_instant(planned, zone), local_instant(real, zone))


def calendar_parts(ts: Column | str) -> dict[str, Column]:
    """Year, ISO weekday (1=Mon … 7=Sun) and hour of a local wall-clock time."""
    t = _c(ts)
    return {
        "ano": F.year(t).cast("int"),
        "dia_sem": (F.weekday(t) + 1).cast("int"),
        "hora": F.hour(t).cast("int"),
    }


def local_day(ts: Column | str) -> Column:
    return F.to_date(_c(ts))


def text_day(text: Column | str) -> Column:
    """First 10 characters of a textual timestamp (``YYYY-MM-DD``)."""
    return F.substring(_c(text), 1, 10)
