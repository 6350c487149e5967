"""Catalogue reconciliation on Spark DataFrames."""
