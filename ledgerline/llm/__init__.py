"""Operators of a training-data pipeline (search, dedup, packing, filtering).

Nothing outside this package imports it; ``queries.py`` holds the registered
queries and ``corpus_pipeline.py`` at the repository top chains four of the
operators.
"""
