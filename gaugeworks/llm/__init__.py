"""Operators of a training-data pipeline: quality, search, joins, packing, files, safety and mixing.

Nothing outside this subpackage imports it.
"""
