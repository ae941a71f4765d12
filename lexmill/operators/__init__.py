"""Operators: each takes DataFrames and returns DataFrames; none collects a data-sized result to the driver."""
