"""snapmetrics: Spark-native analytics over repeatedly observed data (snapshots, listings, pages, prices)."""

__version__ = "0.1.0"
