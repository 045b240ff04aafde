"""Analyses: functions from a DataFrame of transactions (or of an earlier result) to a DataFrame.

All of them are lazy plans of built-in expressions, aggregates, windows and joins with constant
lookup tables. Windows run on aggregated rows, never on transactions.
"""
