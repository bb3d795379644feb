"""Quarterdeck: entity-quarter panel, macro-series and loan-tagging analytics on Spark DataFrames."""
