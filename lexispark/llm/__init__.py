"""Operators for training-data pipelines, one module per operator, and their
registered queries (``queries.py``).  Nothing outside this package imports it."""
