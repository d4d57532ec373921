"""Every registered query of the library's own operators, with its SQL.

This module imports those that register queries, and none of them imports it:
an executor that loads a function of one of them loads that one first.
"""

from telar.catalog_records import QUERIES, SQL  # noqa: F401
from telar import catalog_more, catalog_changes  # noqa: E402, F401, I001  # register their queries, in this order
