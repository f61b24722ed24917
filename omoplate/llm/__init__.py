"""Operators for preparing training text, and their driver queries.

Nothing outside this package imports it; it may import the library's
general helpers.
"""
