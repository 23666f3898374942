"""Operators: functions from DataFrames to DataFrames. "Today" is always a parameter, and order is always a column."""
