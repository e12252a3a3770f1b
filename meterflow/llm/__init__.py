"""Training-data operators: tokenising, archives, dedup, quality, PII, extraction.

Nothing outside this subpackage imports it. ``queries.py`` registers one query
per operator, ``oracle.py`` holds their DuckDB text where SQL can say it.
"""
