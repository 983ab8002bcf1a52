"""Column-level building blocks: every function returns a ``Column`` made of
built-in Spark expressions (whole-stage codegen, no Python UDF)."""

from .decode import decode, literal_map
from .geo import in_box, orient, parse_coordinates, parse_number
from .labels import day_period, route_key, route_label, weekday_label
from .times import (
    calendar_parts,
    delay_minutes,
    local_day,
    local_instant,
    parse_local_time,
    text_day,
    valid_local_time,
)

__all__ = [
    "decode", "literal_map", "in_box", "orient", "parse_coordinates", "parse_number",
    "day_period", "route_key", "route_label", "weekday_label", "calendar_parts",
    "delay_minutes", "local_day", "local_instant", "parse_local_time", "text_day",
    "valid_local_time",
]
