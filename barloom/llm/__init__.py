"""Operators that prepare training text: cleaning, scoring, near copies, tokens, packing.

Nothing else in the library imports this subpackage.
"""
