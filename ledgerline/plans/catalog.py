"""All registered queries."""

from ledgerline.plans import files, live, rows, scalars  # noqa: F401
from ledgerline.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
