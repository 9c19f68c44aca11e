"""Relational operators of the lake, each a DataFrame -> DataFrame function."""
