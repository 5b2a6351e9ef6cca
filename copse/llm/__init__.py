"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage; ``queries.py`` binds
the operators to the driver's tables.
"""
