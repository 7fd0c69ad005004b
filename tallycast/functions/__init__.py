"""Column expressions: IEEE numerics and calendar labels."""
