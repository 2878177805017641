"""Technical-document analytics on Spark DataFrames."""
