"""Payment-transaction risk analytics on Spark: DataFrames in, DataFrames out."""

__version__ = "0.1.0"
