"""Change-data engine for metadata catalogs on Spark DataFrames and Structured Streaming."""
