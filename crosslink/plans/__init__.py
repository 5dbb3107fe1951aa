"""The operators over the driver's tables: one query each, most of them with the same result in SQL."""

from __future__ import annotations

from crosslink.plans import graphs, matching, measures, records, ruling, sequences, stored
from crosslink.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "graphs", "matching", "measures", "ruling", "sequences"]
