"""Hourly time-series panels on Spark: ingest, merge, features, forecasts, evaluation.

Every public function takes DataFrames and returns DataFrames; nothing runs
until the caller writes or counts the result.
"""
