"""Column expressions: no actions, no shuffles, no Python per row."""
