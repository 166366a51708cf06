"""Analytics on banking balance series, built on Spark DataFrames."""
