"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage.  Each ``opN`` module has the
operator with its general interface; :mod:`tidewake.llm.queries` holds the thin queries.
"""
