"""Column-level functions: text, numbers and ordered CASE rules."""
