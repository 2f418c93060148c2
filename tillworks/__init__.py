"""Tillworks: conform a wide retail-sales feed into clean tables with Spark.

Everything here is a function from DataFrames (or Columns) to DataFrames (or
Columns).  The caller owns the session; no module starts one on import.
"""
