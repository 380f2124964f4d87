"""Customer-spending and revenue analytics as native Spark DataFrame operators."""

__version__ = "0.1.0"
