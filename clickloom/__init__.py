"""Click-log features and conversion-model dataflow, written for Spark."""

__version__ = "0.1.0"
