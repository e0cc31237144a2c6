"""Operators for large training-data pipelines.

Nothing outside this subpackage imports it.  ``queries`` registers the ``opN_*`` queries;
every other module holds one operator with its own general interface.
"""
