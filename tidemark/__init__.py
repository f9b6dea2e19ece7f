"""tidemark: analytics over partitioned event logs, written as plain PySpark jobs."""

__version__ = "0.1.0"
