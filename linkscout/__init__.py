"""Site qualification for point-to-point radio links, on Spark DataFrames."""
