"""Operators of a training-data pipeline, one module per operator.

Every operator takes and returns DataFrames, selects the columns it needs by
name before it adds its own (extra columns of the input, whatever their names,
cannot clash) and accepts nulls in every column; each module's docstring states
what null, empty, tied and repeated rows give.  ``catalog`` holds the registered
queries.
"""
