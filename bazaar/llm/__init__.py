"""Operators of a training-data pipeline over the ``documents`` table.

Nothing else in the library imports this subpackage; the driver entry adds
its queries only when it is present.
"""
