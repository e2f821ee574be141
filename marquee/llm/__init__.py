"""Operators for preparing language-model training data.

Nothing outside this package imports it.  Each operator is a module with a
general function on DataFrames; ``queries.py`` registers the thin ``opN_`` query
of each one beside its SQL twin, and ``corpus_pipeline.py`` at the repository top
chains five of them.
"""
