"""All registered queries."""

from tenderloom.plans import catalog_sources, catalog_streaming, catalog_tables, catalog_text  # noqa: F401
from tenderloom.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
