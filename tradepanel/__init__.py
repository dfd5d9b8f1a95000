"""Country-pair trade panels as Spark DataFrames."""
