"""Behaviour analytics on click and shop logs, written with DataFrames, Spark ML and streaming."""
