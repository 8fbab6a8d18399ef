"""cellweave: a PySpark engine for barcoded single-cell sequencing tables."""

__version__ = "0.1.0"
