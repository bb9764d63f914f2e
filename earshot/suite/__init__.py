"""Every operator as a query over the test tables, with equivalent SQL."""

from earshot.suite.registry import ORACLES, QUERIES
from earshot.suite import activity, catalog, content, files, recommend  # noqa: F401  (they register)

__all__ = ["ORACLES", "QUERIES"]
