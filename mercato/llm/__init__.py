"""Operators for preparing training text: one module per operator, one DataFrame in, one DataFrame out."""
