"""Operators of a large-scale training-data pipeline.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
Each module holds one operator with its own interface; ``queries`` holds
the thin ``opN_<name>`` queries, ``sql`` the DuckDB SQL of those that SQL
can express.
"""
