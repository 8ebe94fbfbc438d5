"""Operators for preparing training text at scale.

One module per operator; ``queries`` applies each to its whole table, ``oracle``
has the SQL equivalents. Nothing outside this package depends on it.
"""
