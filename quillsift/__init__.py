"""Entity screening analytics on Spark DataFrames."""
