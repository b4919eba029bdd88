"""Training-data operators: text, token, archive and similarity jobs over the corpus tables.

Nothing outside this subpackage imports it. ``queries.py`` holds the thin
registered queries, ``oracle.py`` their DuckDB statements.
"""
