"""DataFrame operators: pure functions from DataFrames to DataFrames.

None of them reads the clock, writes, or starts a job; run identifiers and times are arguments.
"""
