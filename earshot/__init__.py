"""earshot: listening-history analytics on Spark DataFrames."""
