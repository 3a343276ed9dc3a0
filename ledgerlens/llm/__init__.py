"""Operators for training-data preparation at corpus scale.

Nothing outside this subpackage imports it; ``queries.py`` holds the registered
queries and their SQL.
"""
