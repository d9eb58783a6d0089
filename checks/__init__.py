"""Independent statements of the results, for checking."""
