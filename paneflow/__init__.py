"""Keyed, windowed aggregation of event streams on Spark."""

from paneflow.layout import Layout

__all__ = ["Layout"]
