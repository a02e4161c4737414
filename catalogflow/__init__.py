"""Catalog data processing on Spark: intake, merge, classify, gate, release, publish."""

__version__ = "0.1.0"
