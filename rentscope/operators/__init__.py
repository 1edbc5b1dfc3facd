"""User-level operators: functions from DataFrames to a DataFrame."""
