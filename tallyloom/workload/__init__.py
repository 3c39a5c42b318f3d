"""The operators run over the benchmark tables, each beside an independent SQL reading of the same question."""

from tallyloom.workload.registry import ORACLES, QUERIES
from tallyloom.workload import activity, costs, events, tracking  # noqa: F401  (they register their queries)

__all__ = ["ORACLES", "QUERIES"]
