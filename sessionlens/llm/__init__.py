"""Operators for preparing large text corpora, kept apart from the rest of the library.

Nothing outside this subpackage imports it, so it can be removed as a whole.
"""
