"""Every operator as a query over the test tables."""

from lexweave.catalogue import (  # noqa: F401  (registration)
    contents,
    feed,
    marts,
    projections,
    relational,
    scans,
    values,
    warehouse,
)
from lexweave.catalogue.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
