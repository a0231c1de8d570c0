"""Operators of a training-data pipeline over text and vector tables. Nothing else in the library imports this."""
