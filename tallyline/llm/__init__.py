"""Operators for preparing training text: one module per operator, `queries.py` for the registered queries."""
