"""Revenue analytics for subscription businesses, as PySpark DataFrame operators.

Every operator takes DataFrames and explicit parameters and returns a lazy
DataFrame.  Nothing in the package reads the clock, collects rows to the driver
or builds a session on its own.
"""
