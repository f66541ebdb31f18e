"""Plumbago: document analytics on Spark DataFrames."""
