"""Jobs made of the operators, and the registered queries."""

from importlib import import_module

QUERY_MODULES = ["keyed_queries", "row_queries", "io_queries"]


def load_all() -> None:
    """Register every query."""
    for module in QUERY_MODULES:
        import_module(f"dripline.plans.{module}")
