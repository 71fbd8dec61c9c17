"""Operators that prepare text for training: joins, scans, models and sharding.

Nothing else in the library imports this subpackage.
"""
