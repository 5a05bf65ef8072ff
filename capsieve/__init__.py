"""Small-cap market and filings screening as Spark DataFrame operators."""

__version__ = "0.1.0"
