"""The layers of the lake as functions on DataFrames."""
