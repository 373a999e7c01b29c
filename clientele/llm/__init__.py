"""Operators of a training-data pipeline over documents, pages and benchmark items.

Nothing outside this subpackage imports it. Registered queries and their SQL are in
``queries.py`` and ``oracle.py`` of this folder.
"""
