"""Tessera: catalog integration and training-data preparation on Spark DataFrames."""
