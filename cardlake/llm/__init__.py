"""Operators of a training-data pipeline over document, benchmark and chat tables.

Nothing else in ``cardlake`` imports this subpackage. Each module holds one
operator; ``queries`` holds the registered queries.
"""
