"""Operators for preparing training corpora at scale.

Nothing else in the library imports this package; ``catalog`` holds the registered
queries.  Each module is one operator with its own general interface.
"""
