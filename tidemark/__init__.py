"""Event analytics on Spark tables and streams.

Every operator takes and returns DataFrames; see README.md for the map.
"""
