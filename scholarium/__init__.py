"""Research-corpus analytics on Spark DataFrames."""
