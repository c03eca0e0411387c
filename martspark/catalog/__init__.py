"""Named queries (Spark) and their DuckDB oracles."""

from . import q_staging, q_sales, q_customers, q_marts, q_service, q_stock, q_governance  # noqa: F401  (registration side effects)
from .registry import ORACLES, QUERIES, presentable  # noqa: F401
