"""Transfer-graph analytics on Spark DataFrames."""
