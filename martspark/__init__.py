"""martspark: a Spark-native sales, customer, inventory and receivables mart.

Operators are DataFrame-in / DataFrame-out functions (``martspark.operators``)
over ERP source frames (``martspark.sources``); ``martspark.catalog`` registers
named queries with DuckDB oracle SQL for cross-engine checks.
"""

__version__ = "0.1.0"
