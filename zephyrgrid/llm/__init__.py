"""Operators for preparing training text: filtering, sharding, archiving, deduplication, scoring and packing.

Nothing outside this subpackage imports it; `queries.py` registers its queries.
"""
