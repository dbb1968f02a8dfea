"""Importing this module registers every query."""

from . import (  # noqa: F401
    clean_queries,
    feature_queries,
    forecast_queries,
    ingest_queries,
    profile_queries,
    sequence_queries,
)
from .registry import ORACLES, QUERIES  # noqa: F401
