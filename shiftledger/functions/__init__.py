"""Column-level helpers; native expressions only."""
