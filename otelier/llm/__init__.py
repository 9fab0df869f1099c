"""Operators that prepare training text: filtering, deduplication, anonymising, tokenizing, packing and vector search.

Nothing else in the library imports this subpackage.
"""
