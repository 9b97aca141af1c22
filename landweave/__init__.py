"""Spatial opportunity analytics on Spark."""
