"""Operators of a large-scale training-data pipeline.

One module per operator; ``queries`` binds them to the driver tables. Nothing
outside this package imports it.
"""
