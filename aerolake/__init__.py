"""aerolake — flight-operations cleaning and analytics on Spark DataFrames."""

from .columns import CLEAN_COLUMNS, COLS, FlightColumns, missing_columns, to_ascii_names
from .session import build_session, ensure_checkpoint_dir

__version__ = "0.1.0"

__all__ = ["CLEAN_COLUMNS", "COLS", "FlightColumns", "missing_columns", "to_ascii_names",
           "build_session", "ensure_checkpoint_dir"]
