"""Operators for building language-model training corpora at scale.

Nothing outside this subpackage imports it.  Each module holds one operator
with a general interface; ``queries`` binds the operators to the tables.
"""
