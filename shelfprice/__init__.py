"""Listing price analytics on Spark: load, clean, describe and browse marketplace listings."""

__version__ = "0.1.0"
