"""Build-provenance analytics on Spark DataFrames."""
