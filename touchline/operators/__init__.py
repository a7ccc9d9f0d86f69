"""Generic table operators: they take DataFrames and column names and know nothing about football."""
