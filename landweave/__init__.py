"""A land-cover analytics engine on Spark DataFrames."""
