"""Operators for building language-model training data from large corpora.

Nothing outside this subpackage imports it.  `queries.py` holds the thin
registered queries, every other module one operator with a general interface.
"""
