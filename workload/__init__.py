"""The registered queries: the library's operators over whole tables."""

from workload import cleaning, dashboard, features, modelling, profiling, relational, reporting, storage  # noqa: F401
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
