"""Transaction and fraud analytics on Spark DataFrames."""
