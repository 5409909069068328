"""Operators for large training-data pipelines, one module each.

Nothing outside this package imports it.  ``queries`` and ``oracles`` hold what
``__spark_entry__`` registers.
"""
