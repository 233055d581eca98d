"""Relational operators of the panel pipeline, all DataFrame -> DataFrame."""
