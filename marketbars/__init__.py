"""Daily market-bar analytics on Spark DataFrames."""
