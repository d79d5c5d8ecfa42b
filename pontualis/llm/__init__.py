"""Operators for preparing training text at scale.

Each module holds one operator with its own general interface; ``queries`` derives the
registered results from them.  Nothing else in the library imports this package.
"""
