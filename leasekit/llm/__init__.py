"""Operators of a training-data pipeline (see README, "llm"). Nothing else in the package imports this."""
