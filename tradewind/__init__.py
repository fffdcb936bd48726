"""Commerce event and order analytics on Spark DataFrames and Structured Streaming."""

from tradewind.config import Settings

__all__ = ["Settings"]
