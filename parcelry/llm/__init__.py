"""Operators of a training-data pipeline over the table of documents."""
