"""Operators for preparing training text; ``queries`` registers them on the given tables."""
