"""The operators of the pipeline, each a function from DataFrames to DataFrames."""
