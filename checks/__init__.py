"""Registered queries and the SQL each one is compared with."""

import checks.relational  # noqa: F401
import checks.profiling  # noqa: F401
import checks.modelling  # noqa: F401
import checks.closed_forms  # noqa: F401
import checks.linear  # noqa: F401
import checks.boosting  # noqa: F401
import checks.streams  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
