"""Operators of a training-data pipeline, and the queries that apply them to the given tables.

Nothing outside this package and ``corpus_pipeline.py`` imports it.
"""
