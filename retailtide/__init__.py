"""retailtide: an online shop's real-time warehouse as PySpark jobs."""

__version__ = "0.1.0"
