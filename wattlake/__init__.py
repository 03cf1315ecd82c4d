"""wattlake: a Spark-first engine for consolidating semi-structured program records."""

__version__ = "0.1.0"
