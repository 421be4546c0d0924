"""Operators: a scope (or a result frame) and parameters in, a DataFrame out."""
