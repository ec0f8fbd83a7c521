"""Operators for preparing training text; `queries` registers them."""
