"""Barcoded-molecule analytics on Spark."""
