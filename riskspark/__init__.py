"""riskspark: transaction-risk analytics as Spark DataFrame, ML and Structured Streaming operators."""

__version__ = "0.1.0"
