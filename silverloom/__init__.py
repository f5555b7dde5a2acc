"""Warehouse analytics on Spark DataFrames: ingest, table transforms, checks, models."""
