"""The jobs, each a user-level function."""
