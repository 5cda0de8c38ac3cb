"""Training-data operators on ``documents``-like tables.

Every operator is a function over DataFrames; ``queries.py`` binds each one to
its table with production parameters. Nothing outside this folder imports it.
"""
