"""Detector-event analytics on Spark DataFrames."""
