"""Satellite-fleet telemetry analytics on Spark DataFrames."""
