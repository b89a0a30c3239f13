"""Operators of a training-data pipeline, and the queries that bind them to the tables."""
