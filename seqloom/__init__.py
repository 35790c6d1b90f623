"""seqloom: curation, processing and analysis of large read collections on Spark DataFrames."""

__version__ = "0.1.0"
