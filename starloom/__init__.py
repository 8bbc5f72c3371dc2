"""Graph analytics, embedding and map tiling on Spark DataFrames."""
