"""Operators for preparing training data at scale.

Each module holds one operator with its own interface; ``queries`` binds them
to the registered queries.  Nothing outside this package imports it.
"""
