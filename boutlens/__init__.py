"""Point-in-time analytics over head-to-head contests, on Spark DataFrames."""
