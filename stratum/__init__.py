"""Layered batch pipelines (bronze, silver, gold, serving) on Spark DataFrames."""
