"""Operators for training-data pipelines over document, page and embedding tables.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its general interface, its registered ``opN_<name>`` query and,
where SQL can express it, the DuckDB twin.
"""
