"""Telemetry analytics on Spark: flat tables and DataFrame operators for logs, spans, metrics and profiles."""

from otelier.session import build_session, configure

__all__ = ["build_session", "configure"]
