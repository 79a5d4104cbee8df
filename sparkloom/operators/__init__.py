"""Relational steps of the relay."""
