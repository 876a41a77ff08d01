"""Price-index analytics on Spark DataFrames."""
