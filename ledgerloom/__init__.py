"""Company-filing analytics on Spark: fact tables in, clean panels and rankings out."""

__version__ = "0.1.0"
