"""Composite plans: cleaning pipeline, insight bundles, report, test inputs."""

from .catalogue import ResultCatalogue
from .insights import delay_insights, route_bundle
from .report import map_input, report, unpersist_report
from .transform import load_or_build, map_rows, run_batch, transform

__all__ = [name for name in dir() if not name.startswith("_")]
