"""Learning-behaviour log analytics on Spark DataFrames."""
