"""Operators for training-data pipelines (text, pages, vectors).

Nothing outside this folder (but the guarded import in the driver entry file)
depends on it.  ``queries.py`` registers one query per operator.
"""
