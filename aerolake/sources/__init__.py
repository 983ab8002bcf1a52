"""Sources and sinks."""

from .csv import common_type, read_csv, read_flights_csv, union_relaxed
from .drift import read_parquet_relaxed, schema_groups
from .files import expand_glob, first_lines, is_committed, path_exists
from .lookups import read_code_map, read_lookup_records
from .order import head_in_source_order
from .quoted import quoted_records, read_quoted_csv
from .sinks import (YEAR_PARTITION, csv_to_ndjson, export_csv, export_parquet, read_parquet,
                    read_parquet_bytes, with_year_partition, write_clean)

__all__ = [name for name in dir() if not name.startswith("_")]
