"""Operators for large-scale training-data work.

Each module is one operator over Spark DataFrames; ``queries`` registers them.
Nothing else in the library imports this subpackage.
"""
