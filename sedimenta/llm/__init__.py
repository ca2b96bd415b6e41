"""Operators for preparing training text.

Nothing outside this subpackage imports it.  Each operator module holds the
general operator; ``queries`` registers the thin digest queries.
"""
