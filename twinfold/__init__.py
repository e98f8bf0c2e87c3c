"""Near-duplicate analytics for content-addressed collections, on Spark DataFrames."""
