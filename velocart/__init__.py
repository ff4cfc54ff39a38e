"""velocart: retail (bicycle-shop) analytics on the Spark DataFrame API.

Subpackages
-----------
sources     typed loads, scans, namespace and stored-table writes
functions   column-level helpers (NULL-safe truth, completed years, casts)
operators   reusable DataFrame operators: audits, dedupe, joins, top-k, set ops
plans       the composite reports and the bindings to the test tables
"""

from velocart.session import build_session

__all__ = ["build_session"]
