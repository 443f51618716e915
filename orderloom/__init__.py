"""orderloom: Spark table operators for e-commerce click-stream analytics."""

__version__ = "0.1.0"
