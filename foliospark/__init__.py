"""foliospark: corpus analytics on Spark DataFrames."""
