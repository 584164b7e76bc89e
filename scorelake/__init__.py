"""Play-by-play analytics on Spark DataFrames."""
