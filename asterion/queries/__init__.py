"""Queries over the given tables, one per operator, with checking SQL."""

from . import (  # noqa: F401
    q_discovery,
    q_stations,
    q_consensus,
    q_time,
    q_quality,
    q_text,
    q_jobs,
)
from .registry import ORACLES, QUERIES  # noqa: F401
