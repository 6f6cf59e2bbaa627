"""Column functions: every rule that works on values of one row."""
