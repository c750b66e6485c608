"""Operators of a training-data pipeline: score, filter, de-duplicate, mix, format and encode text."""
