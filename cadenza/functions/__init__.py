"""Column functions: JSON paths, parsing, deterministic keys and text."""
