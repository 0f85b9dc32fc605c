"""Operators: functions from DataFrames (and as_of) to a DataFrame."""
