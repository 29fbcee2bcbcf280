"""Set-based loyalty and promotion analytics on Spark DataFrames."""
