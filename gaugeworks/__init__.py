"""Gauge-series analytics as Spark DataFrame jobs keyed by station."""

from gaugeworks.session import configure, cut_lineage, get_session, scratch_path

__all__ = ["configure", "cut_lineage", "get_session", "scratch_path"]
