"""Media-streaming analytics as plain DataFrame functions on Spark."""

__version__ = "0.1.0"
