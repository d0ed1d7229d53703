"""Spark-native analytics for disaster news and hazard events."""

from emberlink.session import build_session, cut_lineage, scratch_dir

__all__ = ["build_session", "cut_lineage", "scratch_dir"]
