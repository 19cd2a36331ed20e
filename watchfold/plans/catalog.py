"""All registered queries and their SQL twins."""

from __future__ import annotations

from watchfold.plans import (  # noqa: F401
    q_analyst,
    q_features,
    q_models,
    q_profiles,
    q_quality,
    q_risk,
    q_rolling,
    q_sources,
    q_stream,
)
from watchfold.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
