"""The operators run over the given tables, each with an independent SQL statement of the same question."""

from workload import energy, gold, incidents, ingest, layouts, mutation, quality  # noqa: F401
from workload.registry import CASES

__all__ = ["CASES"]
