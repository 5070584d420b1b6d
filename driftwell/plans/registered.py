"""Imports every query module, so that the catalog is complete."""

from driftwell.plans import (  # noqa: F401
    q_counting,
    q_drift,
    q_ml,
    q_models,
    q_profile,
    q_reports,
    q_sources,
    q_streaming,
    q_ticks,
)
from driftwell.plans.catalog import QUERIES

__all__ = ["QUERIES"]
