"""Dialog and transcript analytics on Spark DataFrames."""
