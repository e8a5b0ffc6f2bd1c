"""Column expressions over coordinates and text."""
