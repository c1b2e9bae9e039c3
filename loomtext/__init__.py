"""Text preparation and vector retrieval on Spark DataFrames."""
