"""Hourly wager rollups as PySpark DataFrame operators.

Every operator is a function from DataFrames to a DataFrame. Nothing in the package creates
a session or reads the clock: the batch hour is always a parameter.
"""
