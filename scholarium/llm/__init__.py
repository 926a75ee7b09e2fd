"""Operators for large training-text pipelines; queries are in :mod:`scholarium.llm.queries`."""
