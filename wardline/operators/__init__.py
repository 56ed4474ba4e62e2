"""Operators: plain DataFrame functions grouped by family (see README)."""
