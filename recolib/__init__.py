"""recolib: product-recommendation analytics on Spark DataFrames.

Sub-packages:
  sources    fixture tables, text parsers, result store
  functions  column expressions (no Python UDFs)
  operators  statistics, similarity, ALS, online scoring, serving
  plans      the named query catalogue and its DuckDB oracle text
  streaming  Structured Streaming jobs around the batch operators
"""

__version__ = "0.1.0"
