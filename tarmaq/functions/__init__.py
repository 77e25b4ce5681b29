"""Column expressions. Everything here is a built-in expression; no Python runs per row."""
