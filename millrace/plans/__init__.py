"""Registered queries over the test tables."""

from millrace.plans import (  # noqa: F401
    q_features, q_missing, q_models, q_parts, q_profile, q_reshape, q_rows, q_sources, q_streaming, q_text,
)
from millrace.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
