"""Survey, laboratory and feature-class preparation on Spark DataFrames."""
