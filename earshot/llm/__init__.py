"""Operators of a training-data pipeline over whole document, vector and dialogue tables."""
