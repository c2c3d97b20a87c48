"""Operators of a training-data pipeline: ten document operators and their queries."""
