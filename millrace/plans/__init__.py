"""Named queries over the given tables and their SQL counterparts."""

from millrace.plans import anomalies, checking, history, journals, loading, messages, metrics, people, reporting, texts  # noqa: F401
from millrace.plans.registry import QUERIES

__all__ = ["QUERIES"]
