"""Every operator as a query over the test tables, with the SQL that gives the same rows."""

from gleanfield.plans.catalog import columns, sites, tables  # noqa: F401
from gleanfield.plans.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
