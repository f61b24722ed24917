"""Column-level helpers: every function maps Column(s) to a Column."""
