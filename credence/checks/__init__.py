"""checks."""
