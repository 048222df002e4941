"""Operators for large-scale training-data preparation.

Each module holds one operator and the thin query over it; ``registry`` lists
the queries. Nothing outside this subpackage imports it.
"""
