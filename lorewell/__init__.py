"""Corpus building, batch retrieval and answer evaluation on plain Spark.

Every operator takes DataFrames and returns a DataFrame. Nothing runs until the
caller writes or collects, except where a docstring says otherwise.
"""
