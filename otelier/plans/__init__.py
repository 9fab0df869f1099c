"""Derived telemetry, the registered queries and their SQL counterparts."""

from importlib import import_module

MODULES = ("flattening", "attribute_queries", "relational_queries", "trace_queries", "metric_queries",
           "profile_queries", "io_queries")


def load_all() -> None:
    """Import every query module, which fills the registry."""
    for name in MODULES:
        import_module(f"otelier.plans.{name}")
