"""Telemetry analytics for fleets of Spark applications, written as Spark jobs."""

from telescale.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
