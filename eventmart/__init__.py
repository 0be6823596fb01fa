"""Clickstream lakehouse toolkit on open-source Spark.

Every operator is a plain function from DataFrame to DataFrame; the
``plans`` package composes them into marts and monitors, ``streaming``
wires them to Structured Streaming.
"""
