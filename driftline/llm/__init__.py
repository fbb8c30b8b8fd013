"""Operators for preparing training corpora: scans, mixing, sharding, language, archives, duplicates, search.

Nothing else in the package imports this folder; the queries are registered by ``queries.py``.
"""
