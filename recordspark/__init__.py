"""Record, graph and vector queries as lazy Spark DataFrames."""
