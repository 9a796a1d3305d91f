"""Composed jobs and the named query registry (with its SQL oracle)."""
