"""Every operator as a query over the given tables, with its SQL twin."""

from urlsheaf.plans.catalogue.registry import ORACLE, QUERIES
from urlsheaf.plans.catalogue import (  # noqa: F401  registers its queries
    fetching,
    functions,
    partitioning,
    reports,
    storage,
    telemetry,
)

__all__ = ["ORACLE", "QUERIES"]
