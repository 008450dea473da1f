"""Text mining and supervised text classification on Spark DataFrames."""
