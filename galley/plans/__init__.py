"""The warehouse as functions from DataFrames to DataFrames, layer by layer."""
