"""DataFrame → DataFrame operators of the flight-operations engine."""

from .aggregates import (date_bounds, filter_options, flights_per_day, kpis, sample_rows,
                         status_distribution, top_routes, unique_values)
from .clean import (completed_flights, domestic_only, drop_unused, invalid_local_times,
                    late_flag, localise, remove_invalid_flights, unparsable_times)
from .delay import (delay_base, delay_by_airline, delay_by_airport, delay_by_period,
                    delay_by_weekday, delay_by_year, top_airlines_per_year)
from .enrich import (airline_dimension, airport_dimension, decode_codes, decode_with_table,
                     enrich_airline, enrich_airports, first_by_key, known_endpoints)
from .filters import FilterSpec, apply_filters, day_condition, filter_condition
from .projection import drop_strict, select_cast
from .routes import route_intensity, route_map, route_nodes
from .yoy import (delays_per_year_airport, yoy_decreases, yoy_increases, yoy_variation,
                  yoy_variation_with_fallback)

__all__ = [name for name in dir() if not name.startswith("_")]
