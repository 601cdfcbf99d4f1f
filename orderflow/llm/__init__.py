"""Operators for preparing training text, with their queries and SQL.

Nothing else in the package imports this subpackage.
"""
