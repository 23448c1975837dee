"""Legislative analytics on Spark DataFrames."""
