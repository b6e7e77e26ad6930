"""Ocean-profile pipeline, queries and search on Spark DataFrames."""
