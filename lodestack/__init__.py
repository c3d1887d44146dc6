"""lodestack: content-addressed artifact analytics on Spark DataFrames."""
