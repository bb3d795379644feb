"""Column factories: missing-value rules, key cleaning, name resolution."""
