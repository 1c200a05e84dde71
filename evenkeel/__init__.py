"""Table validation and warehouse marts on Spark DataFrames."""
