"""Operators of a training-data pipeline, each built by one named method.

Nothing outside this folder imports it.  All operators read `doc_id`/`text` (or the columns their
docstring names) and ignore every other column, so extra columns cannot clash with their own.
"""
