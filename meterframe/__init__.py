"""Panel time series (smart-meter style) analytics on Spark DataFrames."""
