"""The registered queries: each runs an operator over the given tables, most with an SQL oracle."""

from tablecare.plans.catalogue import (  # noqa: F401 - importing registers the queries
    coercing,
    health,
    jobs,
    merging,
    ranking,
    referencing,
    searching,
    streaming,
)
from tablecare.plans.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
