"""Column expressions and the declarative settings they take."""
