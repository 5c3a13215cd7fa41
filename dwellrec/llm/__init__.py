"""Operators for large training-data corpora.

Thirteen operators, one module each, plus ``queries.py`` (their registered queries
and oracle SQL). Nothing else in the library imports this package. Modules
with Python workers need the package on the executors (``--py-files`` or an
image); the two native ones (``line_chunks``, ``digest_merge``) do not.
"""
