"""Operators for preparing training text: encode, pack, deduplicate, score and mix.

Nothing else in the library imports this package.  Each module holds one
operator; ``queries`` binds the operators to the test tables.
"""
