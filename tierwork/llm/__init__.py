"""Operators of a training-data pipeline, each usable on any DataFrame, and their queries (``llm.queries``)."""
