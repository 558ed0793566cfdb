"""All registered queries."""

from . import audit_queries, rule_queries, series_queries, spectral_queries, stat_queries  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
