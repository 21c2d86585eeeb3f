"""Operators for preparing training text at scale, their queries and their SQL.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""
