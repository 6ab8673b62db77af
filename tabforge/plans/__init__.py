"""Registered queries (Spark builders + DuckDB oracle SQL) and pipelines."""

from .registry import ORACLE, QUERIES  # noqa: F401
from . import q_quality, q_clean, q_profile, q_ml, q_resample, q_drift, q_pipeline, q_extra, q_live  # noqa: F401
