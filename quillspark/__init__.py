"""A corpus-processing engine on Spark DataFrames."""
