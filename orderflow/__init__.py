"""Order analytics on Spark: clean, deduplicate, enrich and aggregate orders.

The same DataFrame operators serve static tables and Structured Streaming.
"""

__version__ = "0.1.0"
