"""Relational operators: intervals, alignment, turns, audits, identity, vectors, loading."""
