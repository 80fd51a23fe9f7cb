"""Column expressions shared by the operators (no Python runs per row)."""
