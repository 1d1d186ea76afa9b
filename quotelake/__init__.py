"""Daily fund and stock price analytics on Spark DataFrames."""
