"""Relay of web feeds as Spark jobs."""
