"""Operators for training-data pipelines over document, page and benchmark tables.

Each operator has a module of its own; ``queries`` applies them to whole tables and
``sql`` holds the DuckDB twins. Nothing outside this package imports it.
"""
