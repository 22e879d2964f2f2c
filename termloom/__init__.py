"""Text-sentiment analytics on Spark DataFrames."""
