"""lexmill: analytics over regulatory decision practice, written for Spark's DataFrame API."""

__version__ = "0.1.0"
