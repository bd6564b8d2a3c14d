"""Spark-first analytics for event logs, chart tables and versioned tables.

Everything is a function from DataFrame to DataFrame.  Batch and streaming
frames share the stateless ones.
"""

__version__ = "0.1.0"
