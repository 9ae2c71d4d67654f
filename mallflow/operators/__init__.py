"""Relational operators. Each takes and returns DataFrames and does no output."""
