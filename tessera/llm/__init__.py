"""Operators for training-data pipelines, their registered queries and tests' subjects."""
