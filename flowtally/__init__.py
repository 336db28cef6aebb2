"""flowtally: hourly flow series -- batch results, stream results and the
checks that compare them -- on Spark DataFrames and Structured Streaming."""

__version__ = "0.1.0"
